"""Joins and connected components that no key can tip: heavy keys are broadcast, the rest is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import shared_table

SMALL = 100_000   # a side of at most this many narrow rows is broadcast as it is
HEAVY_SHARE = 500  # beyond it, keys with over 1/500 of the other side's rows are: fewer than 500 of them


def look_up(rows: DataFrame, values: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``values``, which has one narrow row per key; both are written tables.

    A key of ``rows`` may hold any share of them.  ``how`` is inner or left; a null key finds nothing."""
    if values.count() <= SMALL:
        return rows.join(F.broadcast(values), on, how)
    bar = max(1000, rows.count() // HEAVY_SHARE)
    heavy = F.broadcast(shared_table(rows.where(F.col(on).isNotNull()).groupBy(on).count().where(F.col("count") > bar).select(on), "heavy"))
    hot = rows.join(heavy, on, "left_semi").join(F.broadcast(values.join(heavy, on, "left_semi")), on, how)
    cold = rows.join(heavy, on, "left_anti").join(values, on, how)
    return hot.unionByName(cold)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``edges`` (a, b); stars of any size.

    Each round takes the smallest label of a node's neighbours, then follows the label's own label; rounds
    are written tables and end when no label changes."""
    arrows = edges.where("a <> b")
    both = shared_table(arrows.select("a", "b").union(arrows.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = shared_table(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = look_up(both, labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = shared_table(labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("next")), "step")
        far = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = shared_table(look_up(step, far, "next", "left").select(
            "node", F.least("next", F.coalesce("far", "next")).alias("label"), F.col("label").alias("before")), "labels")
        if after.where("label <> before").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
