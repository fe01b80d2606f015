import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from binlens.llm import decontamination as D


@given(st.lists(st.integers(0, 4), max_size=9), st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=150, deadline=None)
def test_common_length(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    assert D.common_length(D._masks(a), len(a), b) == table[-1, -1]


def test_answers():
    assert D.answer_of("What is it? It is a cat.") == "It is a cat." and D.answer_of("Only one") == "Only one"


@pytest.fixture(scope="module")
def planted(spark, documents):
    """Clean texts with whole items, changed items (about one word in seven) and parts of items put in."""
    r = random.Random(5)
    items = [(x.item_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    clean = [x.text.split() for x in documents.where("doc_id % 3 = 0").limit(200).collect()]
    pool = [w for t in clean for w in t]
    docs, want = [], set()
    for k in range(300):
        text = [r.choice(pool) for _ in range(r.randint(30, 500))]
        if k < 120:
            item_id, t = items[k % len(items)]
            words = t.split()
            if k >= 60:
                words = [r.choice(pool) if r.random() < 0.1 else w for w in words if r.random() > 0.05]
            at = r.randint(0, len(text))
            text[at:at] = words
            want.add((k, item_id))
        docs.append((k, " ".join(text)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), want


def test_planted_items(planted):
    docs, benchmark, want = planted
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, benchmark).collect()}
    whole = {(d, i) for d, i in want if d < 60}
    assert whole <= got and got <= want and len(got) >= 0.95 * len(want)


def test_candidate_search_against_brute_force(planted):
    """Recall of the vector search alone, and of the whole search, over all pairs that the exact check confirms."""
    docs, benchmark, _ = planted
    items = D.read_items([tuple(r) for r in benchmark.collect()])
    vocabulary = D.number_words(items)
    read = D.keyed(docs)
    index = D.build_index(read, D.read_texts(read, vocabulary), items, vocabulary)
    rows = docs.collect()
    s = D.segments(pa.array([r.text for r in rows]), vocabulary)
    found, by_cosine = set(D.candidates(s, index)), set(D.candidates(s, index, by_share=False))
    exact = set()
    for d in range(len(rows)):
        for i, item in enumerate(items):
            for at in range(int(s.ptr[d]), int(s.ptr[d + 1])):
                a, b = np.searchsorted(s.segment, [at, min(int(s.ptr[d + 1]), at + item.segments)])
                if b - a >= D.COMMON_SHARE * len(item.words) and D.common_length(
                        item.masks, len(item.words), s.word[a:b].tolist()) >= D.COMMON_SHARE * len(item.words):
                    exact.add((d, i))
                    break
    print(f"{len(exact)} pairs: {len(exact & by_cosine)} by cosine, {len(exact & found - by_cosine)} by the share of the item alone")
    assert len(exact) > 100 and len(exact & by_cosine) >= 0.9 * len(exact) and exact <= found


def test_basis_is_learned_from_all_texts(spark):
    """The vectors are those of a plain sum over the segments of 6,000 texts, none of which is left out."""
    r = random.Random(3)
    pool = [f"w{k}" for k in range(400)]
    items = D.read_items([(k, " ".join(r.sample(pool, 40))) for k in range(30)])
    vocabulary = D.number_words(items)
    texts = [" ".join(r.choice(pool[k % 50 * 8:][:16]) for _ in range(20)) for k in range(6000)]
    docs = D.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7))
    index = D.build_index(docs, D.read_texts(docs, vocabulary), items, vocabulary)
    s = D.segments(pa.array(texts), vocabulary)
    n, size = int(s.ptr[-1]), len(vocabulary)
    idf = np.maximum(np.log((1 + n) / (1 + np.bincount(s.word, minlength=size))), 0.1).astype(np.float32)
    weight = np.where(index.content, idf, 0)
    matrix, own = np.zeros((n, size)), np.zeros((len(items), size))
    np.add.at(matrix, (s.segment, s.word), weight[s.word])
    for row, item in zip(own, items):
        np.add.at(row, item.words, weight[item.words])
    test = np.random.default_rng(D.SEED).standard_normal((size, D.DIMENSIONS + D.OVERSAMPLED)).astype(np.float32)
    total, mine = matrix.T @ (matrix @ test), own.T @ (own @ test)
    left = np.linalg.svd(total + mine * max(np.linalg.norm(total) / np.linalg.norm(mine), 1.0), full_matrices=False)[0][:, :D.DIMENSIONS]
    got = index.rows[:, :index.dimensions]
    want = weight[:, None] * left
    assert np.abs(got @ got.T - want @ want.T).max() < 0.01 * np.abs(want @ want.T).max()


def test_whole_items_between_other_items(spark):
    """As in a dump of the benchmark, and short items in a sentence: every placement is found."""
    r = random.Random(7)
    items = [(x.item_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    items += [(10_000 + k, " ".join(f"short{r.randint(0, 300)}" for _ in range(r.randint(5, 12)))) for k in range(60)]
    docs = []
    for k, (_, t) in enumerate(items * 2):
        before, after = ([w for _ in range(4) for w in r.choice(items)[1].split()] for _ in range(2))
        docs.append((k, " ".join([*before[r.randint(0, 15):], t, *after])))
    got = {(x.doc_id, x.item_id) for x in D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                       spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(k, i) for k, (i, _) in enumerate(items * 2)} <= got


def test_blocks_give_the_same(planted, monkeypatch):
    docs, benchmark, _ = planted
    small = docs.where("doc_id < 60")
    once = {(r.doc_id, r.item_id) for r in D.find_leaks(small, benchmark).collect()}
    monkeypatch.setattr(D, "BLOCK", 15)
    assert once == {(r.doc_id, r.item_id) for r in D.find_leaks(small, benchmark).collect()}


def test_clean_rows_with_the_id_of_a_leak_stay(spark):
    item = "what did the quick brown fox do when it met the lazy dog? it jumped over the sleeping animal at once."
    clean = [(None, "nothing of note in this text"), (None, "nor in this one"), (None, None), (7, "a clean text with the id of another"), (8, "x")]
    docs = spark.createDataFrame([(None, f"intro {item} end"), (7, item), (7, item), *clean], "doc_id long, text string")
    left = D.without_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, clean))


def test_odd_rows(spark, odd_docs):
    text = odd_docs.where("doc_id = 1").first().text
    items = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "!!", "x"), (None, "one", "x"),
                                   (5, "word " * 300, "x")], "item_id long, text string, doc_id string")
    got = sorted(str((r.doc_id, r.item_id)) for r in D.find_leaks(odd_docs, items).collect())
    assert got == sorted(map(str, [(1, 1), (8, 1), (8, 1), (10, None), (11, None)]))
    assert D.find_leaks(odd_docs.where("false"), items).count() == 0 and D.find_leaks(odd_docs, items.where("false")).count() == 0
    left = D.without_leaks(odd_docs, items)
    assert left.columns == odd_docs.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(i) for i in [2, 3, 4, 5, 6, 7, 9, None, None])
