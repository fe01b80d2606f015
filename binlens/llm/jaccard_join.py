"""N-gram Jaccard self-join by MinHash banding with exact verification.

A text is the set of its five-word windows (a text of one to four words is one window of them all).
Texts with equal sets form a class; one text stands for each class.  Its signature has a band of
MinHash values per tree.  Two classes are candidates if their bands in some tree are equal; all bands
have the one length that finds a pair at the threshold with the target recall, fixed before a text is
read.  This took the place of an LSH forest: no longer prefixes are computed and none is descended.
A class meets another only in the first tree where their bands match, and
buckets whose members all share a bucket of an earlier tree are left out, so no pair is met twice.
Large buckets are split into blocks that meet pairwise.  Every candidate pair is verified on the
full window sets.  Links are counted and joined to groups inside the blocks; pairs are never emitted.

Results per document: ``class_id`` (smallest id of the documents linked to it directly or through
others), ``copy_id`` (smallest id with an equal window set), ``n_links`` (documents at the threshold
or above, copies included).  Null, empty and wordless texts have no window, no link and a class of
their own.  Rows with a null id count as documents and get their class; a class of nothing but null
ids has a null ``class_id``.  Repeated rows are copies of each other.  An empty table gives
an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import row_key, shared_table
from binlens.llm.membership import may_hold
from binlens.llm.words import U, mix, sub_batches, windows, words

WINDOW = 5
THRESHOLD = (4, 5)  # 0.8 as a ratio
TREES = 16
FULL_DEPTH = 12
TARGET_RECALL = 0.9995
BLOCK = 1024
SEED = 5


def depth_for(recall: float = TARGET_RECALL, similarity: float = THRESHOLD[0] / THRESHOLD[1], trees: int = TREES) -> int:
    """The longest prefix, shortened from full depth, that finds a pair of this similarity with this recall."""
    depth = FULL_DEPTH
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


_FACTORS = (mix(np.arange(1, TREES * FULL_DEPTH + 1, dtype=U) + U(SEED << 32)) >> U(32)).astype(np.uint32) | np.uint32(1)
_OFFSETS = (mix(np.arange(1, TREES * FULL_DEPTH + 1, dtype=U) + U(SEED << 40)) >> U(32)).astype(np.uint32)


def forest_keys(hashes: np.ndarray, first: np.ndarray, depth: int) -> np.ndarray:
    """A key per set and tree; set i is ``hashes[first[i]:first[i + 1]]``, none of them empty."""
    low = (hashes >> U(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    keys = np.zeros((len(first) - 1, TREES), U)
    for t in range(TREES):
        for level in range(depth):
            i = t * FULL_DEPTH + level
            least = np.minimum.reduceat(low * _FACTORS[i] + _OFFSETS[i], first[:-1])
            keys[:, t] = mix(keys[:, t] * U(31) + least + U(level + 1))
    return keys.astype(np.int64)


def window_sets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct window hashes of each text that has any, its number, and all of them in a row."""
    w = words(texts)
    hashes, first = windows(w, WINDOW, short_whole=True)
    ptr = np.searchsorted(first, w.ptr)
    has = np.flatnonzero(np.diff(ptr))
    return [np.unique(hashes[ptr[i]:ptr[i + 1]]) for i in has], has, hashes


def digest(windows_of_text: np.ndarray) -> bytes:
    return hashlib.blake2b(windows_of_text.tobytes(), digest_size=16).digest()


def _signatures(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, "text"):
                sets, has, _ = window_sets(part.column("text"))
                digests: list = [None] * part.num_rows
                keys: list = [None] * part.num_rows
                if sets:
                    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                    found = forest_keys(np.concatenate(sets), first, depth)
                    for i, s, k in zip(has.tolist(), sets, found):
                        digests[i], keys[i] = digest(s), k
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "key_1", "key_2")), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "key_1", "key_2", "digest", "keys"])
    return run


def _emit_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The window sets of the texts that stand for a class, once per bucket and pair of blocks."""
    seen: set[bytes] = set()
    names = ["tree", "key", "one", "other", "block", "digest", "copies", "keys", "windows"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        for part in sub_batches(batch, "text", 1 << 20):
            sets, has, _ = window_sets(part.column("text"))
            wanted, copies, keys, cells = (part.column(c).to_pylist() for c in ("digest", "copies", "keys", "cells"))
            out: list[list] = [[] for _ in names]
            for i, s in zip(has.tolist(), sets):
                d = digest(s)
                if d != wanted[i] or d in seen:  # a repeated row
                    continue
                seen.add(d)
                packed = np.array(keys[i], np.int64).tobytes()
                for c in cells[i]:
                    blocks = -(-c["members"] // BLOCK)
                    mine = int.from_bytes(d[:8], "little") % blocks
                    for other in range(blocks):
                        row = (c["tree"], c["key"], min(mine, other), max(mine, other), mine, d, copies[i], packed, s.tobytes())
                        for column, value in zip(out, row):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


CELL = "tree int, key long, one int, other int, block int, digest binary, copies long, keys binary, windows binary"


def _shared_windows(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common windows of every two sets."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[number] > 1
    renumber = np.cumsum(count > 1) - 1
    owner, number = owner[keep], renumber[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    common = np.zeros((n, n), np.float32)
    width = max(64, (8 << 20) // n)
    total = int(number[-1]) + 1 if len(number) else 0
    for a in range(0, total, width):
        lo, hi = np.searchsorted(number, [a, a + width])
        x = np.zeros((n, min(width, total - a)), np.float32)
        x[owner[lo:hi], number[lo:hi] - a] = 1
        common += x @ x.T
    return np.rint(common).astype(np.int64)


def _verify(tree: int, one: int, other: int, rows: dict[str, list]) -> list[tuple[bytes, bytes, int]]:
    """(class, smallest class linked to it in this block, linked documents) of every class with a link."""
    at = {d: i for i, d in enumerate(rows["digest"])}  # a repeated row counts once
    index = sorted(at.values())
    digests = [rows["digest"][i] for i in index]
    sets = [np.frombuffer(rows["windows"][i], U) for i in index]
    keys = np.stack([np.frombuffer(rows["keys"][i], np.int64) for i in index])
    block = np.array([rows["block"][i] for i in index])
    copies = np.array([rows["copies"][i] for i in index])
    size = np.array([len(s) for s in sets])
    common = _shared_windows(sets)
    union = size[:, None] + size[None, :] - common
    link = THRESHOLD[1] * common >= THRESHOLD[0] * union
    np.fill_diagonal(link, False)
    if one != other:
        link &= block[:, None] != block[None, :]
    for t in range(tree):  # met in an earlier tree
        link &= keys[:, t][:, None] != keys[:, t][None, :]
    some = np.flatnonzero(link.any(axis=1))
    if not len(some):
        return []
    link = link[np.ix_(some, some)]
    label = np.arange(len(some))
    while True:
        least = np.minimum(label, np.where(link, label[None, :], len(label)).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    n = link @ copies[some]
    return [(digests[some[i]], digests[some[label[i]]], int(n[i])) for i in range(len(some))]


def _verify_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups arrive sorted; one group of at most two blocks is held at a time."""
    columns = ["block", "digest", "copies", "keys", "windows"]
    current, held = None, {c: [] for c in columns}
    found: list[tuple[bytes, bytes, int]] = []

    def batch_of(rows: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.int64())], names=["digest", "root", "links"])

    for batch in batches:
        group = list(zip(*(batch.column(c).to_pylist() for c in ("tree", "key", "one", "other"))))
        values = {c: batch.column(c).to_pylist() for c in columns}
        for i, g in enumerate(group):
            if g != current:
                if len(held["block"]) > 1:
                    found += _verify(current[0], current[2], current[3], held)
                current, held = g, {c: [] for c in columns}
            for c in columns:
                held[c].append(values[c][i])
        if len(found) > 10_000:
            yield batch_of(found)
            found = []
    if len(held["block"]) > 1:
        found += _verify(current[0], current[2], current[3], held)
    yield batch_of(found)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``edges`` (a, b)."""
    both = shared_table(edges.select("a", "b").where("a <> b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
                                                                     .where("a <> b")).distinct(), "edges")
    labels = shared_table(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("next"))
        # follow the label's own label
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = shared_table(step.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("far", "next")).alias("label"), F.col("label").alias("before")), "labels")
        if after.where("label <> before").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def classes_of(docs: DataFrame, text: str, doc_id: str, recall: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """Id, row key and digest of every document; copy_id, class_id, n_links and the class's first row of every digest.

    The first row is the one with the smallest (id with nulls last, row key)."""
    depth = depth_for(recall)
    key_1, key_2 = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), key_1.alias("key_1"),
                       key_2.alias("key_2"))
    signed = shared_table(rows.mapInArrow(
        _signatures(depth), "doc_id long, key_1 long, key_2 long, digest binary, keys array<long>"), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_1", "key_2")).alias("first")
    classes = shared_table(signed.where("digest IS NOT NULL").groupBy("digest").agg(
        first, F.count("*").alias("copies"), F.first("keys").alias("keys")).withColumn("copy_id", F.col("first.doc_id")), "classes")

    cells = classes.select("digest", F.posexplode("keys").alias("tree", "key"))
    busy = cells.groupBy("tree", "key").agg(F.count("*").alias("members")).where("members > 1")
    met = shared_table(cells.join(busy, ["tree", "key"]).groupBy("digest").agg(
        F.collect_list(F.struct("tree", "key", "members")).alias("cells")).join(classes, "digest"), "met")  # at most TREES cells each
    every = met.select("digest", "keys", F.explode("cells").alias("cell")).select("digest", "keys", "cell.*")
    bounds = [f(F.when(F.col("tree") > t, F.col("keys")[t])).alias(f"{f.__name__}_{t}") for t in range(TREES - 1) for f in (F.min, F.max)]
    same = F.lit(False)
    for t in range(TREES - 1):
        same = same | F.coalesce(F.col(f"min_{t}") == F.col(f"max_{t}"), F.lit(False))
    needed = every.groupBy("tree", "key").agg(*bounds).where(~same).select("tree", "key")
    wanted = shared_table(every.select("digest", "tree", "key", "members").join(needed, ["tree", "key"]).groupBy("digest").agg(
        F.collect_list(F.struct("tree", "key", "members")).alias("cells")).join(classes, "digest"), "wanted")

    group = ["tree", "key", "one", "other"]
    wanted = wanted.withColumns({k: F.col(f"first.{k}") for k in ("key_1", "key_2")})
    some = may_hold(wanted, "key_1", "key_2")  # only texts that may be wanted are shuffled
    texts = rows.where(some(F.col("key_1"), F.col("key_2"))).join(wanted, ["key_1", "key_2"]).select("text", "digest", "copies", "keys", "cells")
    found = shared_table(texts.mapInArrow(_emit_cells, CELL).repartition(*group).sortWithinPartitions(*group).mapInArrow(
        _verify_cells, "digest binary, root binary, links long"), "links")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    smallest = groups.join(classes.select(F.col("digest").alias("node"), "first"), "node").groupBy("label").agg(F.min("first").alias("least"))
    linked = groups.join(smallest, "label").select(F.col("node").alias("digest"), "least")
    known = classes.select("digest", "first", "copy_id", "copies").join(links, "digest", "left").join(linked, "digest", "left").select(
        "digest", "copy_id", F.coalesce("least", "first").alias("first"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.drop("keys"), known.withColumn("class_id", F.col("first.doc_id"))


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, copy_id, n_links of every document."""
    signed, known = classes_of(docs, text, doc_id, recall)
    return signed.select("doc_id", "digest").join(known, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The first row of each class, by (id with nulls last, row key), with all its columns; of rows with its id and its
    text one stays.  Rows whose text has no word stay."""
    signed, known = classes_of(docs, text, doc_id)
    first = (F.col("key_1") == F.col("first.key_1")) & (F.col("key_2") == F.col("first.key_2"))
    ranked = signed.where("digest IS NOT NULL").join(known.select("digest", "first"), "digest").groupBy(
        F.col("key_1").alias("__key_1"), F.col("key_2").alias("__key_2"), first.alias("__first")).count()
    settled = shared_table(ranked.where("NOT __first OR count > 1"), "duplicates")
    # rows that are certainly not settled stay where they are; only the others, with their texts, are shuffled
    some = may_hold(settled, "__key_1", "__key_2")
    key_1, key_2 = row_key(f"`{doc_id}`", f"`{text}`")
    certain = docs.where(~some(key_1, key_2))
    whole = docs.where(some(key_1, key_2)).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), key_1.alias("__key_1"), key_2.alias("__key_2"))
    kept = whole.join(settled, ["__key_1", "__key_2"], "left_anti")
    repeated = settled.where("__first")
    if not repeated.isEmpty():
        again = whole.join(repeated.drop("__first", "count"), ["__key_1", "__key_2"]).dropDuplicates(["__key_1", "__key_2"])
        kept = kept.unionByName(again)
    return certain.unionByName(kept.select(*(F.col("__row").getField(c).alias(c) for c in docs.columns)))
