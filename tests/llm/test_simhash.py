import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from binlens.llm import simhash as S
from binlens.llm.skew import components, look_up

U = np.uint64


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(points):
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def clustered(rng, n):
    """Random points, chains and dense balls of near ones, points exactly at and just beyond the limit."""
    base = rng.integers(0, 1 << 63, n // 4, dtype=np.int64).astype(U)
    out = [base]
    centre = base[:max(2, n // 50)]
    for k in (1, 2, 3, 4, 5, 6):
        flips = np.zeros((n // 10, 64), bool)
        for row in flips:
            row[rng.choice(64, k, replace=False)] = True
        out.append(centre[rng.integers(0, len(centre), len(flips))] ^ np.packbits(flips, axis=1).view(">u8").ravel().astype(U))
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("n, seed", [(400, 1), (3000, 2), (6000, 3)])
def test_shard_links_equal_all_pairs(n, seed):
    points = clustered(np.random.default_rng(seed), n)
    root = S.link_shard(points, np.ones(len(points), bool))
    assert root.tolist() == plain_components(points)


def test_tight_family_is_not_compared_pair_by_pair():
    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)]
    points = np.unique(np.array([0x123456789ABCDEF0 ^ f for f in flips], U))
    far = np.random.default_rng(5).integers(0, 1 << 63, 500, dtype=np.int64).astype(U)
    points = np.unique(np.concatenate([points, far]))
    assert S.link_shard(points, np.ones(len(points), bool)).tolist() == plain_components(points)


def test_routes_bring_every_near_pair_together():
    rng = np.random.default_rng(7)
    points = clustered(rng, 4000)
    tree = S.ShardTree(rng.choice(points, 600, replace=False), 12)
    assert tree.leaves > 4
    at, shard, home = tree.route(points)
    assert sorted(at[home].tolist()) == list(range(len(points)))  # one home each
    lives = dict(zip(at[home].tolist(), shard[home].tolist()))
    seen = set(zip(at.tolist(), shard.tolist()))
    for i in range(0, len(points), 7):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 4).tolist():
            assert (i, lives[j]) in seen or (j, lives[i]) in seen
    assert len(at) < 6 * len(points)  # other branches are pruned


def test_points_over_shards(spark, monkeypatch):
    points = clustered(np.random.default_rng(11), 3000)
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long").repartition(4)
    got = {r["node"]: r["label"] for r in components(S.links(df, shard=300)).collect()}
    want = plain_components(points)
    sizes = np.bincount(want, minlength=len(points))
    groups = {}
    for x, r in zip(points.view(np.int64).tolist(), want):
        if sizes[r] > 1:
            groups.setdefault(r, []).append(x)
        else:
            assert x not in got
    for members in groups.values():
        assert {got[x] for x in members} == {min(members)}


def test_rows_over_shards_grow_with_the_points(spark, monkeypatch):
    """Eight times the points make eight times the rows over shards, five a point, whatever the number of shards."""
    taken = []
    rng = np.random.default_rng(13)
    frames = [spark.createDataFrame([(int(x),) for x in rng.integers(-1 << 63, 1 << 63, n, dtype=np.int64)], "fp long") for n in (1000, 8000)]
    cls = type(frames[0])
    plain = cls.mapInArrow

    def counting(self, func, schema, *rest, **named):
        if schema == "a long, b long":
            taken.append(self.count())
        return plain(self, func, schema, *rest, **named)

    monkeypatch.setattr(cls, "mapInArrow", counting)
    for df in frames:
        S.links(df, shard=200).collect()
    assert len(taken) == 2 and taken[0] <= 5 * 1000 and taken[1] <= 5 * 8000


@pytest.mark.parametrize("shared", [0, 0x7, 0x0123456789ABCDEF, (1 << 59) - 1])
def test_a_near_pair_has_a_part_in_common(shared):
    masks = S.cut(shared)
    other = [m & ~shared for m in masks]
    assert len(masks) == 5 and sum(other) == ~shared & (1 << 64) - 1 and all(m & shared == shared for m in masks)
    assert sum(x.bit_count() for x in other) == 64 - shared.bit_count()  # the parts are disjoint, so four bits spare one


def test_values_with_many_points_are_cut_anew(spark, monkeypatch):
    """Points that share most of their bits: values stay too large through every cut, and no link is lost."""
    monkeypatch.setattr(S, "MAX_TASKS", 6, raising=False)
    rng = np.random.default_rng(17)
    low = rng.integers(0, 1 << 24, 1200, dtype=np.int64).astype(U)
    ball = [0x123456789ABCDEF0 ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)]
    points = np.unique(np.concatenate([low | U(0xABCDEF0000000000), np.array(ball, U), clustered(rng, 1000)]))
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long").repartition(4)
    want = plain_components(points)
    dealt, shards = S.deal(df, 30)
    assert shards > 1 and dealt.count() > 10 * len(points)  # some were cut anew, more than once
    got = {r["node"]: r["label"] for r in components(S.links(df, shard=30)).collect()}
    least = {}
    for x, r in zip(points.view(np.int64).tolist(), want):
        least[r] = min(x, least.get(r, x))
    assert [got.get(x, x) for x in points.view(np.int64).tolist()] == [least[r] for r in want]


def test_documents_against_plain_fingerprints_and_all_pairs(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in S.near_duplicates(documents).collect()}
    assert len(got) == len(rows)
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    points = np.unique(np.array(list(prints.values()), U))
    root = dict(zip(points.tolist(), plain_components(points)))
    least = {}
    for i in sorted(prints):
        least.setdefault(root[prints[i]], i)
    for i, p in prints.items():
        assert got[i]["fingerprint"] == f"{p:016x}"
        assert got[i]["component_id"] == least[root[p]]
    assert len(least) < len(rows)


def test_hashes_are_those_of_spark(spark):
    text = "Der ÄRGER  about\tXXH64\nhashes of words"
    want = spark.sql("SELECT xxhash64('der Ärger about xxh64') AS a").first()["a"]
    assert int(next(S.shingle_hashes(text)).view(np.int64)[0]) == want


def test_long_texts_in_pieces(monkeypatch):
    text = "".join(f"wörd{i % 977} " for i in range(4000)) + "x" * 3000 + " end"
    want = plain_fingerprint(text)
    monkeypatch.setattr(S, "PIECE", 500)
    assert int(S.fingerprints([text, None, "", " \n", "one two", text])[0]) == want
    assert S.fingerprints([text, None, "", " \n", "one two"]).tolist()[1:] == [0, 0, 0, plain_fingerprint("one two")]


def test_odd_documents(spark, odd_docs):
    got = S.near_duplicates(odd_docs.withColumn("fp", F.lit("x")).withColumn("fingerprint", F.lit(1))).collect()
    assert len(got) == odd_docs.count()
    zero = {r["doc_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert {2, 3, 4, None} <= zero
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {2}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 8)} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] in (10, 11)} == {10}
    assert S.near_duplicates(odd_docs.limit(0)).count() == 0


def test_heavy_keys(spark, monkeypatch):
    """A star over two thirds of the nodes and chains, with nothing small enough to be broadcast whole."""
    from binlens.llm import skew
    monkeypatch.setattr(skew, "SMALL", 10)
    star = [(5, i) for i in range(100, 3100)]
    chain = [(i, i + 1) for i in range(10_000, 10_060)]
    df = spark.createDataFrame(star + chain + [(7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {5: 5} | {i: 5 for i in range(100, 3100)} | {i: 10_000 for i in range(10_000, 10_061)}
    rows = spark.createDataFrame([(1,)] * 3000 + [(i,) for i in range(50)] + [(None,)], "k long")
    values = spark.createDataFrame([(i, 2 * i) for i in range(40)], "k long, v long")
    assert sorted(r["v"] for r in look_up(rows, values, "k").collect()) == sorted([2] * 3000 + [2 * i for i in range(40)])
    assert look_up(rows, values, "k", "left").where("v IS NULL").count() == 11
