import numpy as np
from pyspark.sql import functions as F

from binlens.llm import membership as M
from binlens.llm.common import shared_table


def test_no_key_is_missed_and_few_others_pass(spark, monkeypatch):
    rows = spark.range(200_000).select(F.xxhash64("id").alias("a"), F.xxhash64(F.lit(1), "id").alias("b"), "id")
    keys = shared_table(rows.where("id % 4 = 0"), "keys")
    held = M.may_hold(keys, "a", "b")
    got = rows.select((F.col("id") % 4 == 0).alias("inside"), held(F.col("a"), F.col("b")).alias("held")).groupBy("inside", "held").count().collect()
    n = {(r["inside"], r["held"]): r["count"] for r in got}
    assert n[True, True] == 50_000 and (True, False) not in n and n.get((False, True), 0) < 7500
    # too many keys for the greatest filter: rows pass in vain, none is missed
    monkeypatch.setattr(M, "MAX_BLOCKS", 1)
    held = M.may_hold(keys, "a", "b")
    assert rows.where("id % 4 = 0").where(~held(F.col("a"), F.col("b"))).count() == 0


def test_no_keys(spark):
    rows = spark.range(10).select(F.xxhash64("id").alias("a"), F.xxhash64(F.lit(1), "id").alias("b"))
    held = M.may_hold(shared_table(rows.where("false"), "keys"), "a", "b")
    assert rows.where(held(F.col("a"), F.col("b"))).count() == 0
    assert np.array_equal(M._probes(np.array([-1, 5], np.int64))[0], [M.BLOCK - 1, 5])


def test_dotted_column_names_pass_the_join_stage(spark):
    from binlens.llm.jaccard_join import one_of_each
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, "another text", "c")], ["doc_id", "text", "x.y"])
    got = one_of_each(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, text, "a"), (3, "another text", "c")]
