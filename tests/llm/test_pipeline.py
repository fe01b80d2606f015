import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from binlens.llm.common import shared_table

from .test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(shared_table(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_return_documents(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.dtypes == before.dtypes and ids(after) <= ids(before)
        assert after.count() == after.select("doc_id").distinct().count()
    assert [n for n, _ in C.STAGES] == ["quality_rules", "language_id", "ngram_jaccard_join", "decontamination", "packing"]


def test_quality_and_language_keep_good_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in stages[0].join(labels.where("quality = 1"), "doc_id").where(F.size(F.split("text", r"\s+")) >= 25).collect()}
    assert len(good & ids(stages[2])) >= 0.95 * len(good)
    assert not {r.doc_id for r in labels.where("quality = 0").collect()} & ids(stages[1])
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == {c for _, c, _, _ in brute(rows)}


def test_documents_with_items_go(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in stages[3].collect() if any(t in r.text for t in items)}
    assert whole and not whole & ids(stages[4]) and len(ids(stages[3]) - ids(stages[4])) <= len(whole) + 2


def test_every_document_is_packed(spark, stages):
    assert ids(stages[5]) == ids(stages[4])
    got = sorted((r.doc_id, r.piece, r.length) for r in C.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.piece, r.length) for r in stages[5].collect())


def test_odd_rows_pass_every_stage(spark, odd_docs, documents):
    docs = documents.limit(40).select("*", *[F.lit("x").alias(c) for c in odd_docs.columns if c not in documents.columns])
    mixed = docs.unionByName(odd_docs.withColumn("n_chars", F.lit(None).cast("long")))
    for rows in (mixed, mixed.where("false")):
        for name, stage in C.STAGES:
            after = shared_table(stage(spark, rows, SF), f"odd-{name}")
            if name != "packing":
                assert after.columns == rows.columns
            rows = after
        assert rows.count() >= 0
