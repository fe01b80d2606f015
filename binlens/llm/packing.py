"""Packing of token sequences: bound-certified best-fit decreasing with exchange rounds.

A text's tokens are the ids of a public byte-level tokenizer, then the end id 0.  Longer ones than
``capacity`` are cut so that only the first piece may be shorter.  Pieces are dealt into partitions
of about ``PIECES_PER_PARTITION``; each packs its pieces by best-fit decreasing and computes a lower
bound on its bin count from dual feasible functions.  A partition whose bins equal the bound is
certified and final.  The others have a gap: their full bins stay, the pieces of their other bins are
exchanged (dealt anew among half as many partitions) and packed again, until fewer than two partitions
have a gap or a round saves no bin.  Only counts reach the driver.

Null text counts as empty and gives one piece holding the end id.  Equal and repeated rows are
pieces of their own.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import shared_table

CAPACITY = 2048
PIECES_PER_PARTITION = 1 << 16


def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids.  ``path`` names a tokenizer file (``.json``), or the same vocabulary as ranks (``.tiktoken``),
    which gives the same ids several times faster.  The added tokens of the tokenizer file, for ranks those
    of the file of that name beside them, are one id each wherever a text holds their name."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added: dict[str, int] = {}
    if os.path.exists(beside := os.path.splitext(path)[0] + ".json"):
        with open(beside, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        if any(name in text for name in added):
            return encoding.encode(text, allowed_special="all", disallowed_special=())
        return encoding.encode_ordinary(text)
    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; only the first may be shorter than ``capacity``."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
           capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
                for key, text in zip(part.column("doc_id").to_pylist(), part.column("__text").to_pylist()):
                    ids = array("I", encode(text or "")).tobytes() + b"\0\0\0\0"  # unsigned, 4 bytes, little-endian
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        out["doc_id"].append(key)
                        out["piece"].append(k)
                        out["start"].append(start)
                        out["length"].append(length)
                        out["ids_crc32"].append(zlib.crc32(ids[4 * start:4 * (start + length)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                     pa.array(out["length"], pa.int64()), pa.array(out["ids_crc32"], pa.int64())], names=list(out))

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Greatest bound of two families of dual feasible functions on the number of bins."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    weight = count * size
    up_to, weight_to = np.cumsum(count), np.cumsum(weight)
    best = -(-int(weight_to[-1]) // capacity)
    # sizes over capacity - lam count as a whole bin, sizes under lam as nothing
    lam = np.arange(0, capacity // 2 + 1)
    large = up_to[-1] - up_to[capacity - lam]
    middle = weight_to[capacity - lam] - np.where(lam > 0, weight_to[np.maximum(lam - 1, 0)], 0)
    best = max(best, int(np.max(large + -(-middle // capacity))))
    # sizes rounded down to multiples of capacity / k, exact multiples of capacity / (k + 1) kept
    for k in range(1, 101):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        value = np.where(exact, size * k, scaled // capacity * capacity)  # in units of 1 / k
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every piece, and the number of bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms, n = 0, 0  # bit r of rooms: a bin with room r is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + ((fitting & -fitting).bit_length() - 1)
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, n
            n += 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, n


def _pack_partition(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy()
        b, at, n = best_fit_decreasing(lengths, capacity)
        room = capacity - np.bincount(b, weights=lengths, minlength=n).astype(np.int64)
        bound = lower_bound(lengths, capacity)
        return pdf.assign(bin=b, offset=at, bins=n, gap=n - bound, room=room[b])
    return run


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECE}, part long, bin long, offset long, bins long, gap long, room long"


def pack(pieces_table: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION,
         exchange: bool = True) -> DataFrame:
    """The pieces with sequence_id and offset.  ``pieces_table`` is read several times: pass a written one."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    todo, n = pieces_table, pieces_table.count()
    done: list[DataFrame] = []
    open_bins: int | None = None  # that the pieces of this round filled before it
    r = 0
    while True:
        parts = max(1, -(-n // per_partition))
        # a running number deals out equal rows too
        dealt = todo.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(r)), F.lit(parts)))
        packed = shared_table(dealt.groupBy("part").applyInPandas(_pack_partition(capacity), PACKED), f"packed-{r}")
        final = packed.select(*names, "offset", F.struct(F.lit(r).alias("round"), "part", "bin").alias("place"), "gap", "room")
        by_part = packed.groupBy("part").agg(F.max("gap").alias("gap"), F.max("bins").alias("bins"))
        total = by_part.agg(F.coalesce(F.sum((F.col("gap") > 0).cast("long")), F.lit(0)).alias("gaps"), F.coalesce(F.sum("bins"), F.lit(0)).alias("bins")).first()
        saved_none = open_bins is not None and total["bins"] >= open_bins
        if not exchange or saved_none or total["gaps"] < 2:
            done.append(final)
            break
        # a partition's pieces outside full bins are exchanged if it has a gap and another one has one, too
        open_now = (F.col("gap") > 0) & (F.col("room") > 0)
        done.append(final.where(~open_now))
        todo = packed.where(open_now).select(*names, "offset")
        left = todo.agg(F.count("*").alias("pieces"), F.sum((F.col("offset") == 0).cast("long")).alias("bins")).first()
        open_bins, n = left["bins"] or 0, min(left["pieces"], per_partition * (total["gaps"] // 2))
        todo = todo.drop("offset")
        r += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # a bin's number within a partition takes 24 bits, a round's number (partitions halve each round) 6
    place = F.col("place")
    sequence = (place["part"] * (1 << 30) + place["round"] * (1 << 24) + place["bin"]).cast("long")
    return out.select(*names, sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
                   capacity: int = CAPACITY) -> DataFrame:
    return pack(shared_table(pieces(docs, tokenizer_path, text, doc_id, capacity), "pieces"), capacity)
