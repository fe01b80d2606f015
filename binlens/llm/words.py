"""Vectorised words of Arrow text columns: positions and 64-bit hashes, no Python loop per word.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``.  Word hashes are polynomial
(random byte table, odd base, modulo 2**64) and finalised by a bit mixer, so equal words have
equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# white space, ASCII punctuation and symbols
MARKS = WHITE.copy()
MARKS[[c for c in range(128) if not chr(c).isalnum()]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
_LOWER_BYTE = _BYTE[_LOWER]
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        step = U((_BASE, _INVERSE)[which])
        out = np.full(max(n, 1 << 21), step, U)
        out[0] = U(1)
        _powers[which] = np.multiply.accumulate(out)
    return _powers[which][:n]


def sub_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose texts hold about ``max_bytes`` (a longer text stands alone)."""
    lengths = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))
    group = (np.cumsum(lengths) // max_bytes).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


@dataclass
class Words:
    data: np.ndarray     # bytes of all texts
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray   # word j is data[starts[j]:ends[j]]
    ends: np.ndarray
    ptr: np.ndarray      # text i has words ptr[i] to ptr[i + 1]
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def text(self, j: int) -> bytes:
        return self.data[self.starts[j]:self.ends[j]].tobytes()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offs, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    n = len(data)
    total = np.zeros(n + 1, U)
    np.cumsum((_LOWER_BYTE if lower else _BYTE)[data] * _power(0, n), out=total[1:])
    spans = (total[ends] - total[starts]) * _power(1, n + 1)[starts]
    return mix(spans + (ends - starts).astype(U))


def words(texts: pa.Array, lower: bool = False, breaks: np.ndarray = WHITE) -> Words:
    """Words of every text; ``breaks`` marks the bytes that part words."""
    data, offsets = raw_bytes(texts)
    inside = ~breaks[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    ptr = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, ptr, span_hashes(data, starts, ends, lower))


def windows(w: Words, size: int, short_whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size``-word window and the first word of each.

    ``short_whole``: a text with 1 to ``size`` - 1 words counts as one window of all its words.
    """
    n = len(w.hashes)
    room = np.repeat(w.ptr[1:], w.counts) - np.arange(n)
    first = np.flatnonzero(room >= size)
    out = np.zeros(len(first), U)
    for k in range(size):
        out = mix(out * U(3) + w.hashes[first + k] + U(k + 1))
    if short_whole:
        short = np.flatnonzero((w.counts > 0) & (w.counts < size))
        if len(short):
            extra = np.zeros(len(short), U)
            for k in range(size - 1):
                has = w.counts[short] > k
                at = np.minimum(w.ptr[short] + k, n - 1)
                extra = np.where(has, mix(extra * U(3) + w.hashes[at] + U(k + 1)), extra)
            first = np.concatenate([first, w.ptr[short]])
            out = np.concatenate([out, mix(extra + U(0x5851F42D4C957F2D))])
            order = np.argsort(first, kind="stable")
            first, out = first[order], out[order]
    return out, first


def per_text(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text's range ``ptr[i]:ptr[i + 1]``."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[ptr[1:]] - total[ptr[:-1]]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points and offsets of a text column; null counts as empty, broken UTF-8 as U+FFFD."""
    data, offsets = raw_bytes(texts)
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return points, before[offsets]
    except UnicodeDecodeError:
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        return (np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32),
                np.concatenate([[0], np.cumsum([len(p) for p in parts])]))


def letter_numbers(numbered: dict[int, int], blank: int) -> np.ndarray:
    """Number of every code point: that of its lower case, 1 for other letters, ``blank`` for white space, else 0."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            out[c] = numbered.get(ord(ch.lower()[0]), 1)
    out[[9, 10, 11, 12, 13, 32]] = blank
    return out


@dataclass
class LetterWords:
    """Words as runs of letters: ``stream[starts[j]:starts[j] + lengths[j]]`` holds the numbers of word j."""

    stream: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    ptr: np.ndarray    # text i has words ptr[i] to ptr[i + 1]
    first: np.ndarray  # first[k] is a word of the k-th spelling
    back: np.ndarray   # word j has spelling back[j]


def letter_words(texts: pa.Array, number: np.ndarray, blank: int, part: int) -> LetterWords:
    """White space parts words, other characters that are no letters are left out, longer words fall into parts."""
    points, offsets = code_points(texts)
    stream = np.insert(number[points], offsets[1:], blank)  # each text ends with a blank of its own
    offsets = offsets + np.arange(len(offsets))
    keep = stream != 0
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    stream = stream[keep]
    gaps = np.flatnonzero(stream == blank)
    starts = np.concatenate([[0], gaps[:-1] + 1])[:len(gaps)]
    lengths = gaps - starts
    if lengths.max(initial=0) > part:
        parts = np.maximum(1, -(-lengths // part))
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, lengths = np.repeat(starts, parts) + nth * part, np.repeat(lengths, parts) - nth * part
        lengths = np.minimum(lengths, part)
    starts, lengths = starts[lengths > 0], lengths[lengths > 0]
    key = np.zeros(len(starts), U)
    alive = np.arange(len(starts))
    for p in range(int(lengths.max(initial=0))):
        alive = alive[lengths[alive] > p]
        key[alive] = mix(key[alive] * U(31) + stream[starts[alive] + p])
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    return LetterWords(stream, starts, lengths, np.searchsorted(starts, offsets), first, back)
