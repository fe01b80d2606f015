import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from binlens.llm import jaccard_join as J


def brute(rows):
    """(class_id, copy_id, n_links) per row number by comparing all pairs."""
    sets = []
    for i, (_, t) in enumerate(rows):
        w = (t or "").encode().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else None)
    n = len(rows)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                    links[a] += 1
                    links[b] += 1
                    parent[find(a)] = find(b)
    groups, copies = defaultdict(list), defaultdict(list)
    for i in range(n):
        groups[find(i)].append(rows[i][0])
        copies[frozenset(sets[i]) if sets[i] else i].append(rows[i][0])
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    return [(rows[i][0], least(groups[find(i)]), least(copies[frozenset(sets[i]) if sets[i] else i]), links[i]) for i in range(n)]


def near_copies(seed, bases, each, changes):
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(bases):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(3, 160))]
        for _ in range(r.randint(1, each)):
            t = list(base)
            for _ in range(r.randint(0, changes)):
                t[r.randrange(len(t))] = f"w{r.randint(0, 400)}"
            rows.append((k, " ".join(t)))
            k += 1
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = near_copies(block, 30, 25, 4)
    rows += [(len(rows) + i, rows[0][1]) for i in range(40)]  # a hot group of copies
    got = sorted(map(tuple, J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    want = sorted(brute(rows))
    links = sum(w[3] for w in want)
    assert [g[0] for g in got] == [w[0] for w in want] and sum(abs(g[3] - w[3]) for g, w in zip(got, want)) <= 0.003 * links
    assert all(g[2] == w[2] for g, w in zip(got, want)) and sum(g[1] != w[1] for g, w in zip(got, want)) <= 0.01 * len(rows)


def test_depth():
    d = J.depth_for(0.99)
    assert 1 - (1 - 0.8 ** d) ** J.TREES >= 0.99 > 1 - (1 - 0.8 ** (d + 1)) ** J.TREES
    assert J.depth_for(0.5) > J.depth_for(0.9999)


def test_common_windows():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    got = J._shared_windows(sets)
    assert all(got[a, b] == len(np.intersect1d(sets[a], sets[b])) for a in range(30) for b in range(30) if a != b)


def test_components(spark):
    r = random.Random(1)
    pairs = [(f"n{i:03}", f"n{i + 1:03}") for i in range(0, 60) if i % 20 != 19]  # three long chains
    pairs += [("a", "b"), ("b", "a"), ("c", "c")]
    r.shuffle(pairs)
    got = {x.node: x.label for x in J.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got["n019"] == "n000" and got["n039"] == "n020" and got["n059"] == "n040" and got["b"] == "a" and "c" not in got


def test_odd_rows(spark, odd_docs):
    got = sorted(map(str, map(tuple, J.join(odd_docs).collect())))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    # a class of its own for every text without a word
    want = sorted(str((i, c if t and t.split() else i, k if t and t.split() else i, n))
                  for (i, c, k, n), (_, t) in zip(brute(rows), rows))
    assert got == want
    assert J.join(odd_docs.where("false")).count() == 0


def test_one_of_each(spark, odd_docs):
    left = J.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, 9, 10, None, None]))
    rows = near_copies(4, 12, 10, 2)
    rows += [(0, rows[0][1])]  # the smallest id twice
    left = J.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {c for _, c, _, _ in brute(rows)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


def test_one_of_each_by_row(spark):
    """Null ids and repeated ids in one table: rows are decided one by one."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    lone = [f"n{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (None, near), (1, "another text under the same id"), (2, near), (2, "unique text under an id that goes"),
            (None, "one"), (None, "two"), (None, "two"), (None, None), (None, None), (5, ""), (5, ""),
            (None, " ".join(lone)), (None, " ".join([*lone[:-1], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(map(str, map(tuple, J.one_of_each(docs).collect())))
    of_lone = [r for r in left if "n0 n1" in r]
    assert len(of_lone) == 1
    assert sorted(set(left) - set(of_lone)) == sorted(map(str, {rows[k] for k in (0, 3, 5, 6, 7, 9, 11)}))
    assert len(left) == 10 and left.count(str((None, None))) == 2 and left.count(str((5, ""))) == 2
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in J.join(docs.where("length(text) > 0")).collect()), key=str)
    assert got == sorted(((i, c, n) for i, c, _, n in brute([r for r in rows if r[1]])), key=str)


def test_recall_on_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.where("doc_id >= 850").collect()]
    got = {r.doc_id: r.n_links for r in J.join(documents.where(F.col("doc_id") >= 850)).collect()}
    assert got == {i: n for i, _, _, n in brute(rows)}
