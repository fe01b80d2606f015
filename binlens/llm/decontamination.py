"""Benchmark decontamination by latent semantic retrieval, confirmed by common subsequences.

Words are runs of letters, digits and bytes over 127, A-Z lower-cased.  Texts are cut into segments of
``SEGMENT`` words; a passage is a run of segments as long as the benchmark item asked for, from every
segment on, so that any placement of an item lies within a passage.  A passage's vector is its TF-IDF
over the words of the benchmark (frequencies: in all texts, by segment; very frequent words have no
weight), projected on the leading right singular vectors of TF-IDF segments.  They come from a randomised SVD: products of the segment
matrix of all texts with a random test matrix are summed across tasks, the benchmark's
own segments are added, and the sum's left singular vectors are the basis.  Every passage of every
text is compared with every item by cosine, and by how much of the item's own TF-IDF weight it holds.
The latter is not projected, so other words in the passage never lower it and a whole copy has 1 at
least; its bar is what the lightest words of the item hold that make up ``COMMON_SHARE``, but not under
``LEAST_HELD``.  What reaches ``COSINE`` or the bar is confirmed by the longest common subsequence with
the item (share of its words) and with its answer, the last sentence.

The benchmark is taken in blocks of ``BLOCK`` item passages (items of more than ``ITEM_WORDS`` words are
several passages), each block in a pass over the texts, so what is broadcast is bounded.  A pass reads
the texts once and writes their benchmark words by segment; the search reads only those.

Null and empty texts and items without a word match nothing.  Equal items are all reported; repeated
rows are reported once each.  An empty table on either side gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import row_key, shared_table
from binlens.llm.packed import pack, unpack
from binlens.llm.words import MARKS, Words, sub_batches, words

SEGMENT = 16
ITEM_WORDS = 64
BLOCK = 256
DIMENSIONS = 128
OVERSAMPLED = 16
PRODUCT_WORDS = 1 << 14  # words whose rows are held at a time
SLICE = 16  # words of the vocabulary whose sums are added up together
COSINE = 0.6
LEAST_HELD = 0.1
# words seen in over one of twelve segments have no weight, except in items with fewer others than that
LEAST_IDF = 2.5
LEAST_CONTENT = 4
COMMON_SHARE = 0.65
ANSWER_SHARE = 0.5
SEED = 11


def read_words(texts: pa.Array) -> Words:
    return words(texts, lower=True, breaks=MARKS)


def answer_of(text: str) -> str:
    """The last sentence that has a word, if there is one before it; else the whole text."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"\w", p)]
    return parts[-1] if len(parts) > 1 else text


@dataclass
class Item:
    item_id: int | None
    part: int
    words: list[int]    # hashes, later vocabulary numbers
    answer: list[int]
    masks: dict[int, int] = field(default_factory=dict)
    answer_masks: dict[int, int] = field(default_factory=dict)

    @property
    def segments(self) -> int:
        """Segments that any placement of the item fits into."""
        return -(-(len(self.words) - 1) // SEGMENT) + 1


def _masks(of: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, h in enumerate(of):
        out[h] = out.get(h, 0) | 1 << i
    return out


def common_length(masks: dict[int, int], length: int, passage: list[int]) -> int:
    """Longest common subsequence, a bit per word of the item."""
    full = (1 << length) - 1
    v = full
    for h in passage:
        if m := masks.get(h):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


def read_items(rows: list[tuple]) -> list[Item]:
    out = []
    for item_id, text in rows:
        hashes = read_words(pa.array([text or ""], pa.large_string())).hashes.tolist()
        answer = read_words(pa.array([answer_of(text or "")], pa.large_string())).hashes.tolist()
        n = -(-len(hashes) // ITEM_WORDS)
        for k in range(n):
            part = hashes[k * len(hashes) // n:(k + 1) * len(hashes) // n]
            out.append(Item(item_id, k, part, answer[-len(part):] if k == n - 1 else part))
    return out


def number_words(items: list[Item]) -> np.ndarray:
    """Vocabulary of the items (sorted hashes); their words become its numbers."""
    vocabulary = np.unique(np.array([h for i in items for h in (*i.words, *i.answer)], np.uint64))
    for i in items:
        i.words = np.searchsorted(vocabulary, np.array(i.words, np.uint64)).tolist()
        i.answer = np.searchsorted(vocabulary, np.array(i.answer, np.uint64)).tolist()
        i.masks, i.answer_masks = _masks(i.words), _masks(i.answer)
    return vocabulary


@dataclass
class Segments:
    """Words of the vocabulary in their order, the segment of each, and the first segment of each text."""

    word: np.ndarray
    segment: np.ndarray
    ptr: np.ndarray


def segments(texts: pa.Array, vocabulary: np.ndarray) -> Segments:
    w = read_words(texts)
    n = -(-w.counts // SEGMENT)
    ptr = np.concatenate([[0], np.cumsum(n)])
    at = np.minimum(np.searchsorted(vocabulary, w.hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == w.hashes)
    doc = w.doc_of_word()[known]
    return Segments(at[known], ptr[doc] + (known - w.ptr[doc]) // SEGMENT, ptr)


def segment_vectors(word: np.ndarray, segment: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """Sum of the words' rows over every segment: the first words of all segments, then the second ones, and so on."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(word):
        first = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1])
        size = np.diff(np.concatenate([first, [len(word)]]))
        order = np.argsort(-size, kind="stable")
        first, size, target = first[order], size[order], segment[first[order]]
        sums = rows[word[first]]
        for k in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -k, side="left"))
            sums[:m] += rows[word[first[:m] + k]]
        out[target] = sums
    return out


READ = "texts binary, seen array<long>"


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text and the key of every row."""
    key_1, key_2 = row_key(doc_id, text)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), key_1.alias("key_1"),
                       key_2.alias("key_2"))


def read_texts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """What the search needs of all texts, written: ids and vocabulary words by segment, and at the end of each task
    how often it has seen each word, and its number of segments."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        seen = np.zeros(len(vocabulary) + 1, np.int64)

        def row(texts: bytes | None, seen: np.ndarray | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([texts], pa.binary()), pa.array([seen], pa.list_(pa.int64()))],
                                              names=["texts", "seen"])

        for batch in batches:
            for part in sub_batches(batch, "text"):
                s = segments(part.column("text"), vocabulary)
                ids = part.column("doc_id")
                keys = [part.column(c).to_numpy() for c in ("key_1", "key_2")]
                seen[:-1] += np.bincount(s.word, minlength=len(vocabulary))
                seen[-1] += s.ptr[-1]
                yield row(pack(*keys, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                               np.diff(s.ptr).astype(np.uint32), s.word.astype(np.uint32),
                               np.bincount(s.segment, minlength=int(s.ptr[-1])).astype(np.uint8)), None)
        yield row(None, seen)

    return shared_table(docs.mapInArrow(run, READ), "segments")


def unpack_texts(raw: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, Segments]:
    *keys, ids, missing, per_text, word, per_segment = unpack(raw)
    return keys, ids, missing, Segments(word.astype(np.int64), np.repeat(np.arange(len(per_segment)), per_segment),
                                  np.concatenate([[0], np.cumsum(per_text.astype(np.int64))]))


def frequencies(read: DataFrame, words_: int) -> tuple[np.ndarray, int]:
    """How often each word occurs in all texts, and the number of segments."""
    out = np.zeros(words_ + 1, np.int64)
    for row in read.where("seen IS NOT NULL").select(F.posexplode("seen").alias("word", "n")).where("n > 0").groupBy("word").agg(
            F.sum("n").alias("n")).collect():
        out[row["word"]] = row["n"]  # at most a row per word of the block
    return out[:-1], int(out[-1])


def basis(read: DataFrame, items: list[Item], weight: np.ndarray) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF segments of all texts, a row per word of the vocabulary."""
    k = min(DIMENSIONS + OVERSAMPLED, len(weight))
    shared = read.sparkSession.sparkContext.broadcast(weight)  # words of one block

    def product(s: Segments, weight: np.ndarray, test: np.ndarray) -> np.ndarray:
        """Transposed segment matrix times segment matrix times test matrix."""
        content = weight[s.word] > 0
        word, segment = s.word[content], s.segment[content]
        out = np.zeros(test.shape)
        if len(word):
            y = segment_vectors(word, segment, int(s.ptr[-1]), test)
            order = np.argsort(word, kind="stable")
            for a in range(0, len(order), PRODUCT_WORDS):
                at = order[a:a + PRODUCT_WORDS]
                first = np.concatenate([[0], np.flatnonzero(np.diff(word[at])) + 1])
                out[word[at][first]] += np.add.reduceat(y[segment[at]], first, axis=0)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        test = np.random.default_rng(SEED).standard_normal((len(weight), k)).astype(np.float32) * weight[:, None]
        total = np.zeros(test.shape)
        for batch in batches:
            for raw in batch.column("texts").to_pylist():
                total += product(unpack_texts(raw)[3], weight, test)
        total = (total * weight[:, None]).astype(np.float32)
        first = [a for a in range(0, len(weight), SLICE) if total[a:a + SLICE].any()]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array([task] * len(first), pa.int64()),
                                          pa.array([total[a:a + SLICE].tobytes() for a in first], pa.binary())],
                                         names=["first", "task", "product"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("task")  # the same sum in every run
        total = sum(np.frombuffer(b, np.float32).astype(float) for b in ordered["product"])
        return pd.DataFrame({"first": [ordered["first"].iloc[0]], "product": [total.astype(np.float32).tobytes()]})

    # every task sums over its texts; the sums are added up by slices of the vocabulary, a few kB a task
    parts = read.where("texts IS NOT NULL").select("texts").mapInArrow(run, "first long, task long, product binary")
    total = np.zeros((len(weight), k))
    for row in parts.groupBy("first").applyInPandas(add_up, "first long, product binary").collect():  # a block's vocabulary
        total[row["first"]:row["first"] + SLICE] = np.frombuffer(row["product"], np.float32).reshape(-1, k)
    # the benchmark's own passages weigh as much as the texts at least
    own = np.zeros((len(items), len(weight)), np.float32)
    for i, item in enumerate(items):
        np.add.at(own[i], item.words, 1)
    own *= weight
    test = np.random.default_rng(SEED).standard_normal((len(weight), k)).astype(np.float32)
    mine = own.T @ (own @ test)
    scale = np.linalg.norm(total) / max(np.linalg.norm(mine), 1e-9)
    left, _, _ = np.linalg.svd(total + mine * max(scale, 1.0), full_matrices=False)
    return left[:, :DIMENSIONS].astype(np.float32)


@dataclass
class Index:
    vocabulary: np.ndarray
    rows: np.ndarray                      # by word: TF-IDF weight times basis, then its share of every item
    dimensions: int                       # columns of the basis
    held: np.ndarray                      # by item: the share of its weight that makes a passage a candidate
    content: np.ndarray                   # words that have a weight
    items: list[Item]
    by_size: dict[int, tuple[np.ndarray, np.ndarray]]  # segments in a passage -> item numbers, unit vectors


def build_index(docs: DataFrame, read: DataFrame, items: list[Item], vocabulary: np.ndarray) -> Index:
    seen, n = frequencies(read, len(vocabulary))
    idf = np.maximum(np.log((1 + n) / (1 + seen)), 0.1).astype(np.float32)
    content = idf >= LEAST_IDF
    for item in items:
        if content[item.words].sum() < LEAST_CONTENT:  # hardly more than frequent words: they all count
            content[item.words] = True
    weight = np.where(content, idf, 0).astype(np.float32)
    rows = weight[:, None] * basis(read, items, weight)
    vectors = np.stack([rows[i.words].sum(axis=0) for i in items])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    size = np.array([i.segments for i in items])
    share = shares(items, weight)
    held = [np.sort(share[item.words, i])[:math.ceil(COMMON_SHARE * len(item.words))].sum() for i, item in enumerate(items)]
    held = np.maximum(np.array(held, np.float32) * 0.999, LEAST_HELD)  # for rounding
    return Index(vocabulary, np.hstack([rows, share]), rows.shape[1], held, content, items,
                 {int(m): (np.flatnonzero(size == m), vectors[size == m]) for m in np.unique(size)})


def shares(items: list[Item], weight: np.ndarray) -> np.ndarray:
    """What one occurrence of a word adds to the product of a passage with an item's TF-IDF, over that of the item itself."""
    out = np.zeros((len(weight), len(items)), np.float32)
    for i, item in enumerate(items):
        np.add.at(out[:, i], item.words, weight[item.words] ** 2)
        out[:, i] /= out[item.words, i].sum()
    return out


def candidates(s: Segments, index: Index, cosine: float = COSINE, by_share: bool = True) -> dict[tuple[int, int], list[tuple[int, float]]]:
    """(text, item) -> first segments and cosines of the passages that reach the cosine or (``by_share``) hold enough of the item."""
    n = int(s.ptr[-1])
    content = index.content[s.word]
    vectors = segment_vectors(s.word[content], s.segment[content], n, index.rows)
    doc = np.repeat(np.arange(len(s.ptr) - 1), np.diff(s.ptr))
    found: dict[tuple[int, int], list[tuple[int, float]]] = {}
    passage, covered = vectors.copy(), 1
    for m in sorted(index.by_size):
        while covered < m:
            if n > covered:
                same = doc[covered:] == doc[:-covered]
                passage[:-covered] += vectors[covered:] * same[:, None]
            covered += 1
        numbers, unit = index.by_size[m]
        projected, held = passage[:, :index.dimensions], passage[:, index.dimensions + numbers]
        length = np.maximum(np.sqrt(np.einsum("ij,ij->i", projected, projected)), 1e-9)
        score = projected @ unit.T
        for a, i in zip(*np.nonzero((score >= cosine * length[:, None]) | (by_share & (held >= index.held[numbers])))):
            found.setdefault((int(doc[a]), int(numbers[i])), []).append((int(a), float(score[a, i] / length[a])))
    return found


def search(s: Segments, index: Index, cosine: float = COSINE) -> list[tuple]:
    """(text number, item number, cosine, common share, answer share) of every confirmed pair."""
    out = []
    for (d, i), hits in candidates(s, index, cosine).items():
        item = index.items[i]
        best, done = (0.0, 0.0, 0.0), -1
        for at, c in hits:
            if at <= done:  # among the neighbours that were checked at once
                continue
            last = at
            for other, oc in hits:
                if last < other <= last + 1:
                    last, c = other, max(c, oc)
            done = last
            # the passages, a segment before and one after; words of no item are in no subsequence
            a, b = np.searchsorted(s.segment, [max(int(s.ptr[d]), at - 1), min(int(s.ptr[d + 1]), last + item.segments + 1)])
            region = s.word[a:b].tolist()
            share = common_length(item.masks, len(item.words), region) / len(item.words)
            answer = common_length(item.answer_masks, len(item.answer), region) / max(1, len(item.answer))
            best = max(best, (share, answer, c))
        if best[0] >= COMMON_SHARE and best[1] >= ANSWER_SHARE:
            out.append((d, i, best[2], best[0], best[1]))
    return out


HIT = "doc_id long, item_id long, cosine double, common_share double, answer_share double"
ROW_HIT = "key_1 long, key_2 long, " + HIT


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
               item_id: str = "item_id") -> DataFrame:
    """A row per text and benchmark item that the text holds (best passage of each)."""
    return find_leaking_rows(docs, benchmark, text, doc_id, item_text, item_id).drop("key_1", "key_2")


def find_leaking_rows(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
                      item_id: str = "item_id") -> DataFrame:
    """``find_leaks`` with the key of each row."""
    spark = docs.sparkSession
    rows = keyed(docs, text, doc_id)
    hits: DataFrame | None = None
    for items in _blocks(benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))):
        vocabulary = number_words(items)
        read = read_texts(rows, vocabulary)
        shared = spark.sparkContext.broadcast(build_index(rows, read, items, vocabulary))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for raw in batch.column("texts").to_pylist():
                    keys, ids, missing, s = unpack_texts(raw)
                    # parts of a long item: the best one stands for it
                    best: dict[tuple, tuple] = {}
                    for d, i, c, share, answer in search(s, index):
                        key = (d, index.items[i].item_id)
                        best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (share, answer, c))
                    found = [d for d, _ in best]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(k[found], pa.int64()) for k in keys), pa.array(ids[found], pa.int64(), mask=missing[found].astype(bool)), pa.array([i for _, i in best], pa.int64()),
                         *(pa.array([v[k] for v in best.values()], pa.float64()) for k in (2, 0, 1))],
                        names=["key_1", "key_2", "doc_id", "item_id", "cosine", "common_share", "answer_share"])

        one = read.where("texts IS NOT NULL").select("texts").mapInArrow(run, ROW_HIT)
        hits = one if hits is None else hits.unionByName(one)
    return hits if hits is not None else spark.createDataFrame([], ROW_HIT)


def _blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """Items in blocks, read partition by partition, so the driver holds one block at a time."""
    block: list[Item] = []
    for row in benchmark.where(F.length("text") > 0).orderBy("item_id", "text").toLocalIterator():
        for item in read_items([(row["item_id"], row["text"])]):
            block.append(item)
        if len(block) >= BLOCK:
            yield block
            block = []
    if block:
        yield block


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all their columns.  Rows are told apart by id and text."""
    leaking = shared_table(find_leaking_rows(docs, benchmark, text, doc_id).select(
        F.col("key_1").alias("__leak_1"), F.col("key_2").alias("__leak_2")).distinct(), "leaks")
    key_1, key_2 = row_key(docs[doc_id], docs[text])
    return docs.join(leaking, (key_1 == leaking["__leak_1"]) & (key_2 == leaking["__leak_2"]), "left_anti")
