"""Helpers shared by the operators: tables, split rule, shared intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from binlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_remainder(col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % mod


def row_key(doc_id: str | Column, text: str | Column) -> list[Column]:
    """128 bits that stand for the id and the text of a row, in two columns; nulls have a key, too."""
    doc_id, text = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    parts = [doc_id.isNull(), doc_id.cast("long"), text.isNull(), text.cast("string")]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def with_fields(rows: DataFrame, ddl: str) -> StructType:
    """The fields of ``rows`` but the last (the text), then those of ``ddl``."""
    return StructType([*rows.schema.fields[:-1], *StructType.fromDDL(ddl).fields])


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs one re-read, never a recomputation.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_HASH_RANGE = 1 << 30


def hashed_sample_by_class(df: DataFrame, label: str, key: str, target: int, classes: int = 500) -> DataFrame:
    """About ``target`` rows of each of the ``classes`` most frequent classes, chosen by a hash of ``key``."""
    counts = df.groupBy(label).count().orderBy(F.desc("count"), label).limit(classes).collect()
    keep = F.lit(False)
    for row in counts:
        bar = int(min(1.0, target / row["count"]) * _HASH_RANGE)
        keep = F.when(F.col(label) == F.lit(row[label]), F.pmod(F.xxhash64(key), F.lit(_HASH_RANGE)) < bar).otherwise(keep)
    return df.where(keep).limit(4 * target * max(1, len(counts)))
