import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from binlens.llm import toxicity as T
from binlens.llm.common import split_remainder
from binlens.llm.words import letter_words

ORDINARY = ["the cat sat on the mat and looked at the dog", "a good day for a walk in the park", "we read books at home",
            "the weather was fine and the road was long", "she cooks soup for all of us", "they plant trees near the lake"] * 4
TOXIC = [t + f" you grobble{e} fool" for t, e in zip(ORDINARY, ["ish", "er", "est", "ing", "ed", "y"] * 4)]


@pytest.fixture(scope="module")
def model():
    return T.train({0: [f"{t} number {i}" for i, t in enumerate(ORDINARY)], 1: [f"{t} number {i}" for i, t in enumerate(TOXIC)]})


def test_rare_expressions_of_a_known_kind(model):
    s = model.score(pa.array(["the cat sat on the mat", "the cat sat with grobblement", "grobblelike", "", None, "12 !!", "zzz qqq xxx"]))
    assert s[1] > 0.7 and s[2] > 0.7 and max(s[0], s[3], s[4], s[5], s[6]) < 0.7
    assert s[3] == s[4] == s[5]


def test_classes_are_treated_alike():
    number, blank = T.letter_numbers({ord(c): i + 4 for i, c in enumerate("abcdefghij")}, 71), 71
    sides = []
    for texts in (["abc abd bad", "cab"], ["fee fig", "bad age"]):
        w = letter_words(pa.array(texts), number, blank, T.PART)
        sides.append((w, np.bincount(w.back, minlength=len(w.first))))
    _, evidence, _ = T._kneser_ney(sides)
    _, swapped, _ = T._kneser_ney(sides[::-1])
    assert np.allclose(evidence, -swapped, atol=1e-5) and np.isfinite(evidence).all()


def test_held_out(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rest = split_remainder("doc_id", 3)
    rows = T.score(docs.where(rest == 1), T.fit(docs.where(rest != 1), labels)).join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0)) > 0.75
    assert n.get((0, 1), 0) / (n.get((0, 1), 0) + n.get((0, 0), 0)) < 0.02


def test_odd_rows(spark, odd_docs, model):
    rows = T.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert T.score(odd_docs.where("false"), model).count() == 0
    labels = odd_docs.select("doc_id", F.lit(0).alias("toxic"), F.lit("x").alias("label"))
    assert T.fit(odd_docs, labels) is None  # one class only
    assert {r.score for r in T.score(odd_docs, None).collect()} == {0.0}


def test_columns_that_clash_with_the_operators_own(spark):
    rows = [(i, t, "x", 0, "k") for i, t in enumerate([*ORDINARY, *TOXIC])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, toxic int, key string")
    labels = spark.createDataFrame([(i, int(i >= len(ORDINARY))) for i in range(len(rows))], "doc_id long, toxic int")
    found = T.sample_rows(docs, labels, "text", "toxic", "doc_id").collect()
    assert len(found) == len(rows) and sum(r["label"] for r in found) == len(TOXIC)
    plain = docs.select("doc_id", "text")
    a, b = (T.score(d, T.fit(d, labels)).orderBy("doc_id").collect() for d in (docs, plain))
    assert [r["predicted"] for r in a] == [r["predicted"] for r in b] == [0] * len(ORDINARY) + [1] * len(TOXIC)
