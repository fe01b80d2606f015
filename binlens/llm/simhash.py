"""Near duplicates by SimHash: fingerprints linked at four or fewer differing bits, found by vantage-point trees.

**Fingerprint.**  A-Z is lowered; words are runs outside ``\\x20\\x09-\\x0D``; a shingle is four words joined by
one blank, repeats included (one to three words: all of them).  A bit is 1 if it is set in over half of the
shingles' XXH64 values (seed 42).  A text without words has fingerprint zero, linked like any other.

**Shards.**  Equal fingerprints are one point.  The 64 bits are cut into five parts; two points within four bits
have at least one part in common.  A point is dealt five times, by the value of each part, so rows grow as the points
do.  Values are hashed to shards of about 16,384 rows.  Points of a value that has more rows than
that are cut anew by the bits they do not share, up to three times: at most 5, 25 or 125 rows for such a point.

**Search.**  Within a shard a vantage-point tree parts the points by their Hamming distance to a vantage point: inner
(at most the radius) or outer.  By the triangle inequality a pair within four bits that lies on both sides has its
inner point within four bits of the radius, so only such inner points also visit the outer side, as queries; all
other branches are pruned.  Leaves are compared in full.

Pairs are never listed.  A shard keeps the components found so far: a vantage point takes in every point
within four bits at once, a branch whose points are in one component is pruned, and where points are too
close to be parted only those outside the largest component are compared.  Shards report (point, root) of linked points, which are joined to
components over all shards.

**Defined cases.**  Null, empty and wordless texts have fingerprint zero.  Rows with a null id are documents; the
component's id is its smallest id, null only if no row has one.  Repeated rows give repeated results.
An empty table gives an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import shared_table
from binlens.llm.skew import components, look_up

SHINGLE = 4
SEED = 42
RADIUS = 4
SHARD = 16_384       # rows of a shard, about
MAX_TASKS = 16_384   # beyond, a task links several shards, one after the other
CUTS = 3             # times that points are cut; those of a value that is still too large share 30 bits or more
LEAF = 256
PIECE = 1 << 20      # bytes of a text that are taken apart at a time
U = np.uint64

_BLANK = re.compile(rb"[ \t-\r]")
_SPREAD = np.array([sum((b >> (7 - i) & 1) << (8 * i) for i in range(8)) for b in range(256)], U)


def shingle_hashes(text: str) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, piece by piece; nothing for a text without words."""
    raw = text.encode("utf-8", "replace").lower()  # bytes.lower changes A-Z only
    h, at, tail, some = xxhash.xxh64_intdigest, 0, [], False
    while at < len(raw):
        blank = _BLANK.search(raw, at + PIECE)
        end = blank.start() if blank else len(raw)
        words = tail + raw[at:end].split()
        at = end
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes)[:len(words) - SHINGLE + 1].tolist()
            yield np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:].tolist())], U)
            some, tail = True, words[-(SHINGLE - 1):]
        else:
            tail = words
    if not some and tail:
        yield np.array([h(b" ".join(tail), SEED)], U)


def bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[text, bit] how often each bit (highest first) is set in ``hashes[first[i]:first[i + 1]]``; no text is empty."""
    lanes = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    sizes = np.diff(first)
    chunks = -(-sizes // 255)  # a lane of eight bits holds a sum of 255
    nth = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = np.repeat(first[:-1], chunks) + 255 * nth
    of_text = np.cumsum(chunks) - chunks
    out = np.zeros((len(sizes), 64), np.int64)
    for byte in range(8):
        sums = np.add.reduceat(_SPREAD[lanes[:, byte]], starts)
        bits = sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[:, 8 * byte:8 * byte + 8] = np.add.reduceat(bits, of_text, axis=0)
    return out


def fingerprints(texts: list[str | None]) -> np.ndarray:
    out = np.zeros(len(texts), U)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def settle() -> None:
        if held:
            first = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            set_bits = 2 * bit_counts(np.concatenate(held), first) > np.diff(first)[:, None]
            out[owners] = np.packbits(set_bits, axis=1).view(">u8").ravel().astype(U)
            held.clear()
            owners.clear()

    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if 4 * len(text) > PIECE:  # may come in pieces, which are added up
            total, n = np.zeros(64, np.int64), 0
            for piece in shingle_hashes(text):
                total += bit_counts(piece, np.array([0, len(piece)]))[0]
                n += len(piece)
            out[i] = np.packbits(2 * total > n).view(">u8")[0] if n else 0
            continue
        for piece in shingle_hashes(text):
            held.append(piece)
            owners.append(i)
            size += len(piece)
        if size > 1 << 20:
            settle()
            size = 0
    settle()
    return out


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            prints = fingerprints(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def best_split(points: np.ndarray, candidates: np.ndarray) -> tuple[np.uint64, int, bool]:
    """The vantage point and radius with the fewest comparisons left, and whether there is a split at all."""
    best, least = (candidates[0], 64, False), 1.0
    for v in candidates:
        share = np.cumsum(np.bincount(distances(points, v), minlength=65)) / len(points)
        inner = share[:64]
        strip = inner - np.concatenate([np.zeros(RADIUS), inner[:-RADIUS]])
        left = np.where((inner > 0) & (inner < 1), inner ** 2 + (1 - inner) * (1 - inner + strip), 2.0)
        mu = int(left.argmin())
        if left[mu] < least - 0.02:
            best, least = (v, mu, True), float(left[mu])
    return best


class ShardTree:
    """A vantage-point tree whose leaves are shards; nodes are (vantage, radius, inner child, outer child).

    For few shards: each level sends over a third of random points to both sides, so ``links`` does not deal by it."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.vantage: list[int] = []
        self.radius: list[int] = []
        self.child: list[list[int]] = []
        self.leaves = 0
        self._grow(np.sort(sample), shards)

    def _grow(self, points: np.ndarray, shards: int) -> int:
        if shards > 1 and len(points) > 1:
            spread = points[np.linspace(0, len(points) - 1, min(16, len(points))).astype(int)]
            v, mu, splits = best_split(points, spread)
            if splits:
                node = len(self.vantage)
                self.vantage.append(int(v))
                self.radius.append(mu)
                self.child.append([0, 0])
                inside = distances(points, v) <= mu
                share = max(1, min(shards - 1, round(shards * inside.mean())))
                self.child[node] = [self._grow(points[inside], share), self._grow(points[~inside], shards - share)]
                return node
        self.leaves += 1
        return -self.leaves  # shard number leaves - 1

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the point, shard, whether it lives there) of every home and every visit."""
        out: list[tuple[np.ndarray, int, np.ndarray]] = []
        todo = [(0 if self.vantage else -1, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out.append((at, -node - 1, home))
                continue
            inner, outer = sides(distances(points[at], U(self.vantage[node])), home, self.radius[node])
            todo.append((self.child[node][0], at[inner], home[inner]))
            d_home = home & (distances(points[at], U(self.vantage[node])) > self.radius[node])
            todo.append((self.child[node][1], at[outer], d_home[outer]))
        return (np.concatenate([a for a, _, _ in out]), np.concatenate([np.full(len(a), s) for a, s, _ in out]),
                np.concatenate([h for _, _, h in out]))


def sides(d: np.ndarray, home: np.ndarray, mu: int) -> tuple[np.ndarray, np.ndarray]:
    """Which points go to the inner and which to the outer side; inner points near the radius visit the outer one.

    A visitor meets the home points of both sides that its ball overlaps."""
    reach = d.astype(np.int64)
    inner = np.where(home, reach <= mu, reach <= mu + RADIUS)
    outer = reach > mu - RADIUS
    return inner, outer


class Links:
    """Components of a shard's points: ``root[i]`` is the smallest position of i's component."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                above = self.root[self.root]
                if (above == self.root).all():
                    break
                self.root = above


def link_shard(points: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Root position of every point: pairs within the radius of which one lives here are linked."""
    links = Links(len(points))
    todo = [(np.arange(len(points)), home)]
    while todo:
        at, lives = todo.pop()
        here = np.flatnonzero(lives)
        if not len(here) or (links.root[at] == links.root[at[0]]).all():
            continue
        if len(here) <= LEAF:
            _compare(points, at[here], at, links)
            continue
        spread = points[at[here[np.linspace(0, len(here) - 1, 5).astype(int)]]]
        v, mu, splits = best_split(points[at[here]], spread)
        if not splits:
            _tight(points, at, lives, links)
            continue
        d = distances(points[at], v)
        near = at[d <= RADIUS]
        if len(near) > 1:
            links.merge(near, np.full(len(near), at[np.flatnonzero((d == 0) & lives)[0]]))
        inner, outer = sides(d, lives, mu)
        todo.append((at[inner], lives[inner]))
        todo.append((at[outer], (lives & (d > mu))[outer]))
    return links.root


def _compare(points: np.ndarray, rows: np.ndarray, columns: np.ndarray, links: Links) -> None:
    width = max(1, (1 << 20) // max(1, len(columns)))
    for a in range(0, len(rows), width):
        close = np.flatnonzero(np.bitwise_count(points[rows[a:a + width]][:, None] ^ points[columns][None, :]) <= RADIUS)
        links.merge(rows[a + close // len(columns)], columns[close % len(columns)])


def _tight(points: np.ndarray, at: np.ndarray, lives: np.ndarray, links: Links) -> None:
    """Points too close together to be parted: taken in ball by ball, then compared outside the largest component."""
    for _ in range(64):
        values, counts = np.unique(links.root[at[lives]], return_counts=True)
        apart = links.root[at] != values[counts.argmax()]
        rest = at[lives & apart]
        if len(rest) <= LEAF:
            break
        near = at[distances(points[at], points[rest[0]]) <= RADIUS]
        links.merge(near, np.full(len(near), rest[0]))
    _compare(points, rest, at, links)
    _compare(points, at[~lives & apart], at[lives & ~apart], links)


def cut(shared: int) -> list[int]:
    """Bit masks: ``shared`` with each of ``RADIUS`` + 1 parts of the other bits; a pair within the radius agrees in one of them."""
    other = [i for i in range(64) if not shared >> i & 1]
    return [shared | sum(1 << i for i in other[j::RADIUS + 1]) for j in range(RADIUS + 1)]


def _signed(mask: int) -> int:
    return mask - (mask >> 63 << 64)


def _link_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by shard; one shard is held at a time, at eight bytes a row."""
    current, points = None, []

    def found() -> pa.RecordBatch:
        p = np.unique(np.concatenate(points))  # the root is the smallest fingerprint, whatever the order of arrival
        root = link_shard(p, np.ones(len(p), bool))
        linked = np.flatnonzero(root != np.arange(len(p)))
        return pa.RecordBatch.from_arrays([pa.array(p[linked].view(np.int64)), pa.array(p[root[linked]].view(np.int64))], names=["a", "b"])

    for batch in batches:
        shard, p = batch.column("shard").to_numpy(), batch.column("fp").to_numpy().view(U)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if current is not None and shard[a] != current:
                yield found()
                points = []
            current = shard[a]
            points.append(p[a:b])
    if points:
        yield found()


def deal(points: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """(shard, fp) of every point, once per part of its bits, and the number of shards; near points meet in one.

    Points of a value with more than ``shard`` rows are cut anew instead, all of them."""
    spark, rows, n = points.sparkSession, points.select(F.lit(0).cast("long").alias("mask"), "fp"), points.count()
    if n <= shard:
        return rows.select(F.lit(0).alias("shard"), "fp"), 1
    kept, total, masks = [], 0, [0]
    for left in reversed(range(CUTS)):
        parts = {m: cut(m) for m in masks}
        masks = [c for m in masks for c in parts[m]]
        table = spark.createDataFrame([(_signed(m), _signed(c)) for m in parts for c in parts[m]], "mask long, part long")
        dealt = rows.join(F.broadcast(table), "mask").select(F.col("part").alias("mask"), "fp", F.col("fp").bitwiseAND(F.col("part")).alias("value"))
        total += n * (RADIUS + 1)
        if not left:
            kept.append(dealt)
            break
        large = shared_table(dealt.groupBy("mask", "value").count().where(F.col("count") > shard), "large")
        n = large.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        if not n:
            kept.append(dealt)
            break
        large = F.broadcast(large.select("mask", "value"))
        kept.append(dealt.join(large, ["mask", "value"], "left_anti"))
        rows = shared_table(dealt.join(large, ["mask", "value"], "left_semi").select("mask", "fp"), "rows")
        total -= n
    shards = -(-total // shard)
    all_kept = kept[0]
    for more in kept[1:]:
        all_kept = all_kept.unionByName(more)
    return all_kept.select(F.pmod(F.xxhash64("mask", "value"), F.lit(shards)).cast("int").alias("shard"), "fp"), shards


def links(points: DataFrame, shard: int = SHARD) -> DataFrame:
    """(a, b) fingerprints, b the root of a's component in some shard; ``points`` has distinct fingerprints ``fp``."""
    dealt, shards = deal(points, shard)
    return dealt.repartition(min(MAX_TASKS, shards), "shard").sortWithinPartitions("shard").mapInArrow(_link_shards, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints = shared_table(rows.mapInArrow(_fingerprint_rows, "doc_id long, fp long"), "fingerprints")
    points = shared_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    edges = shared_table(links(points), "links")
    linked = components(edges).withColumnRenamed("node", "fp")
    labelled = shared_table(points.join(linked, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label")), "labelled")
    smallest = shared_table(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "smallest")
    known = shared_table(look_up(labelled, smallest, "label").select("fp", "component_id"), "known")
    return look_up(prints, known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
