import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from binlens.llm import pitman_yor as M
from binlens.llm.common import split_remainder
from binlens.llm.words import words

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(rows, mod=10):
    tokens = [[*(t or "").encode().translate(LOWER).split(), None] for _, t in rows]
    out = [zlib.crc32(b"" if i is None else str(i).encode()) % mod == 0 for i, _ in rows]
    c = Counter(x for t, o in zip(tokens, out) if not o for x in t)
    n, v = sum(c.values()), len(c)
    return sorted(((i, o, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), 6))
                   for (i, _), t, o in zip(rows, tokens, out)), key=str)


def base_columns(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_base_columns(spark, documents, odd_docs, monkeypatch):
    got = M.score(odd_docs, split_remainder("doc_id", 10) == 0)
    assert base_columns(got) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    docs = documents.where("doc_id % 4 = 1")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert base_columns(M.score(docs, split_remainder("doc_id", 10) == 0)) == want
    monkeypatch.setattr(M, "BUCKET_BYTES", 40_000)
    monkeypatch.setattr(M, "CHUNK_TOKENS", 3_000)
    assert base_columns(M.score(docs, split_remainder("doc_id", 10) == 0)) == want


def test_edges(spark, odd_docs):
    assert M.score(odd_docs.where("false"), F.lit(False)).count() == 0
    rows = M.score(odd_docs, F.lit(True)).collect()  # nothing to learn from
    assert len(rows) == odd_docs.count() and all(r.n_known == 0 and r.score == 0 and r.train_tokens == 0 for r in rows)
    rows = M.score(odd_docs.where("doc_id in (2, 3)"), F.lit(False)).collect()  # end tokens only
    assert all(r.n_tokens == 1 and r.n_known == 1 and math.isfinite(r.score) for r in rows)


def test_better_than_the_base_on_held_out_texts(documents):
    rows = M.score(documents, split_remainder("doc_id", 10) == 0).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_predictive_probabilities_sum_to_one():
    """Over all known words and the unseen one, in every context, after every sweep."""
    rng = np.random.default_rng(1)
    words_, contexts = 12, 5
    counts = rng.integers(0, 40, (words_, contexts)) * (rng.random((words_, contexts)) < 0.6)
    counts[0, 0] = 3
    w, c = (x.ravel() for x in np.meshgrid(np.arange(words_ + 1), np.arange(contexts), indexing="ij"))
    tokens = np.append(counts, np.zeros((1, contexts), int), axis=0).ravel()  # the last word is never seen
    b = M.Bucket(tokens, c, w, np.full(words_ + 1, -1), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))
    shared = M.Shared(M.first_totals(b))
    for n, (tables, _) in enumerate(M.sweeps(b, shared, 0, 0)):
        now = M.Shared(M.totals_of(b, tables))
        parent = now.unigram(np.bincount(w, weights=tables, minlength=words_ + 1))
        assert np.all(tables <= tokens) and np.all((tables > 0) == (tokens > 0))
        assert abs(parent.sum() - 1) < 1e-9  # known words and one unseen word
        p = (np.maximum(tokens - now.discount * tables, 0) + now.new_table()[c] * parent[w]) / (M.STRENGTH + now.context_tokens[c])
        assert np.allclose(np.bincount(c, weights=p), 1)
        if n == 6:
            break


def test_seating_follows_the_restaurant():
    """Mean number of tables against its exact expectation; spans against single seats."""
    customers, discount, weight = 60, 0.6, 1.5
    p = np.zeros(customers + 2)
    p[1] = 1.0
    for seated in range(1, customers):
        t = np.arange(len(p))
        new = np.where(t > 0, weight / (weight + seated - discount * t), 0)
        p = p * (1 - new) + np.concatenate([[0], (p * new)[:-1]])
    mean = (p * np.arange(len(p))).sum()
    got = M.seat(np.full(20_000, customers), np.full(20_000, weight), discount, np.random.default_rng(0))
    assert abs(got.mean() - mean) < 0.1
    long = [M.seat(np.full(3_000, 5_000), np.full(3_000, weight), discount, np.random.default_rng(0)).mean()]
    exact, M.EXACT_SEATS = M.EXACT_SEATS, 10_000
    try:
        long.append(M.seat(np.full(3_000, 5_000), np.full(3_000, weight), discount, np.random.default_rng(1)).mean())
    finally:
        M.EXACT_SEATS = exact
    assert abs(long[0] / long[1] - 1) < 0.05


def test_inventory_counts_all_texts(spark):
    """A word that stands in one text of 20,001, often, is among the most frequent words; texts and ids decide nothing else."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('Common w', id % 3000, ' w', id % 3000) AS text").unionByName(
        spark.createDataFrame([(20_000, "rare " * 500), (20_001, None)], "doc_id long, text string"))
    got = M.take_inventory(docs)
    def hashed(word):
        return words(pa.array([word]), lower=True).hashes[0]
    number = dict(zip(got.own.tolist(), got.number.tolist()))
    assert number[hashed("common")] == 1 and number[hashed("rare")] == 2 and len(number) == M.OWN_CONTEXTS
    assert hashed("rare") in got.hot and M.END in got.hot and len(got.hot) == M.HOT_WORDS


@pytest.mark.parametrize("texts", [["a b a", None, "", "B"], []])
def test_tokens(texts):
    inventory = M.Inventory(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    hashes, context, text = M.tokens(words(pa.array(texts, pa.string()), lower=True), inventory)
    sizes = [len((t or "").split()) + 1 for t in texts]
    assert np.bincount(text, minlength=len(texts)).tolist() == sizes and (hashes == M.END).sum() == len(texts)
    starts = np.cumsum([0, *sizes[:-1]]) if texts else []
    assert all(context[s] == 0 for s in starts) and (context == 0).sum() == len(texts)
