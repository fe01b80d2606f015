"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows of a table read from Parquet files are numbered by file (in the order of their paths) and place
in the file, without a shuffle.  The number is split into two halves of near equal ranges, whose
product is at least the row count; six rounds add a keyed hash of one half to the other, which
permutes that product exactly.  Numbers that fall outside the row count walk on until they are inside.
Position p of the permutation is slot ``p div shards`` of shard ``p mod shards``: shard sizes differ by
at most one row (law ``rows``), slots have no gaps, and both can be computed for any row number.

Null text counts as empty; null ids, ties, and repeated rows get positions of their own.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlens.llm.common import shared_table
from binlens.llm.words import U, mix

SHARDS = 40
SEED = 20_240_229
ROUNDS = 6
ROW_BYTES = 16


def permute(numbers: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """Position of every row number in 0 .. total - 1."""
    left_range = int(np.ceil(np.sqrt(total))) or 1
    while left_range * left_range < total:
        left_range += 1
    a, b = U(left_range), U(-(-total // left_range) or 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))
    out = numbers.astype(U)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] // b, out[walking] % b
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + mix(right + keys[i]) % a) % a
            else:
                right = (right + mix(left + keys[i]) % b) % b
        out[walking] = left * b + right
        walking = walking[out[walking] >= U(total)]
    return out.astype(np.int64)


def number_rows(table: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` and ``row_number`` (from 0) of a table read from Parquet files."""
    rows = table.select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
    counts = table.select(F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(F.count("*").alias("__rows"))
    # one row per file; written, so that its size is known when the join is planned
    before = shared_table(counts.select("__file", (F.sum("__rows").over(Window.orderBy("__file")) - F.col("__rows")).alias("__before")),
                          "rows-before-file")
    return rows.join(before, "__file").drop("__file").withColumn("row_number", F.col("__before") + F.col("__place")).drop("__before", "__place")


def shuffle_into_shards(table: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS,
                        seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    total = table.count()
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = number_rows(table, F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(t).cast("long").alias("text_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = permute(batch.column("row_number").to_numpy(zero_copy_only=False), total, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(["rows"] * len(place), pa.string()), pa.array((place % shards).astype(np.int32)),
                 pa.array(place // shards), pa.nulls(len(place), pa.int32())],
                names=["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"])

    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
