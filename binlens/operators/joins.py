"""Joins that no single key can tip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.session import cut_lineage

HOT_SHARE = 1000    # a key is hot when it holds over 1/1000 of the rows, so fewer than 1000 keys are
HOT_ROWS = 100_000  # and over so many rows: fewer never tip a task


def join_unique(rows: DataFrame, lookup: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``rows``, a written table, with ``lookup``, which has one row per key.

    One partial aggregate finds the hot keys.  Their lookup rows (fewer than ``HOT_SHARE``) are broadcast, so the rows
    of a hot key stay where they were read; all other rows are shuffled by key as usual.  The result is that of the plain
    join; rows with a null key find nothing."""
    total = rows.count()  # from the files' footers
    if total <= hot_rows:
        return rows.join(lookup, on)
    bar = max(hot_rows, total // HOT_SHARE)
    hot = cut_lineage(rows.groupBy(*on).count().where(F.col("count") > bar).select(*on))
    if hot.isEmpty():
        return rows.join(lookup, on)
    few = F.broadcast(hot)
    return (rows.join(F.broadcast(lookup.join(few, on, "left_semi")), on)
            .unionByName(rows.join(few, on, "left_anti").join(lookup, on)))
