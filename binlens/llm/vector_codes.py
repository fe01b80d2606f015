"""Vector code compression: product codebooks trained with norm-of-sum bounds.

Components become integers ``floor(1024 * x)``; a vector is cut into four equal parts, each with a
codebook of up to 256 entries that starts as that part of the vectors with the smallest ids.  A round
assigns every part to its nearest entry (squared Euclidean distance, ties to the lower index), then
replaces each used entry by the floor of its parts' mean.

**Bounds.**  Every part keeps its entry, an upper bound of the distance to it, and for each of eight groups of
entries a lower bound of the distance to the group's other entries.  Each bound carries the stamp of the round
in which it was exact.  The codebooks of all rounds are retained, so a bound made in round ``s`` is carried to
round ``t`` by the *net* displacement ``|C_t - C_s|`` of the entry (the greatest one of a group), the
norm of the summed drifts, which is never more than the sum of the drifts' norms.  Only where the upper bound
reaches a group's lower bound is the distance to the own entry made exact, and only groups still reached
are scanned.  The codes are those of full scans, ties included.

**On Spark.**  A round is one pass over a written table (vector, state); each task adds up its parts by entry, and
only these sums (entries x components) are summed up over tasks and sent to the driver.  Codebooks and
history are of fixed size (rounds x entries x components) and go to the tasks with the function.

**Defined cases.**  Rows whose vector is null or holds a null, NaN or infinity are left out.  Shorter vectors, empty ones
too, count as padded with zeros to the longest one, whose length is rounded up to a multiple of four.
Integer components are limited to +-2**26, where every sum stays exact.  Rows with a null id
come last in the order of ids; equal ids are ordered by their vectors.  With fewer than 256 rows there are as
many entries as rows.  Null labels form one group.  An empty table gives an empty result.  Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from binlens.llm.common import shared_table
from binlens.llm.skew import look_up

SCALE = 1024
LIMIT = 1 << 26
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 8
ROWS = 8192     # vectors held as numbers at a time
SLACK = 1e-6    # relative; covers the rounding of stored bounds and of square roots
FAR = np.int64(1 << 62)


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row of ``x`` to every row of ``c`` (integers)."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)), 1)
    if 4 * top * top * max(1, x.shape[1]) < 1 << 52:  # all sums are exact in doubles
        a, b = x.astype(np.float64), c.astype(np.float64)
        out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return np.rint(out).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k, None] - c[None, :, k]) ** 2
    return out


@dataclass
class Codebooks:
    """``history[t][p]``: the entries of part ``p`` that round ``t`` assigns to (the last: the final ones)."""

    history: list[np.ndarray]
    groups: list[list[np.ndarray]]  # entries of each group, by part, ascending
    evaluations: list[int]          # exact distances computed in each round

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.history[-1].ravel().tolist())).encode()).hexdigest()


def entry_groups(book: np.ndarray, n_groups: int = GROUPS) -> list[list[np.ndarray]]:
    """Entries of each part in groups of near ones, by a few rounds of k-means over the entries alone."""
    out = []
    for entries in book:
        k = min(n_groups, len(entries))
        centres = entries[np.linspace(0, len(entries) - 1, k).astype(int)].astype(np.float64)
        for _ in range(5):
            near = ((entries[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
            for g in range(k):
                if (near == g).any():
                    centres[g] = entries[near == g].mean(0)
        out.append([np.flatnonzero(near == g) for g in range(k) if (near == g).any()])
    return out


def state_type(n_groups: int = GROUPS) -> np.dtype:
    return np.dtype([("code", "u1"), ("at", "u1"), ("upper", "<f4"), ("lower", "<f4", (n_groups,)), ("stamp", "u1", (n_groups,))])


def first_scan(x: np.ndarray, book: np.ndarray, groups: list[np.ndarray], state: np.ndarray) -> tuple[np.ndarray, int]:
    """Assign by a scan of all entries and set every bound; returns squared distances and their number computed."""
    d = squared_distances(x, book)
    rows = np.arange(len(x))
    code = d.argmin(1)
    own = d[rows, code]
    d[rows, code] = FAR
    state["code"], state["at"], state["upper"] = code, 0, _up(np.sqrt(own))
    state["lower"], state["stamp"] = np.float32(np.inf), 0
    for g, members in enumerate(groups):
        state["lower"][:, g] = _down(d[:, members].min(1))
    return own, d.size


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def _down(squares: np.ndarray) -> np.ndarray:
    """Stored lower bound of squared distances; FAR (no entry) has none."""
    root = np.sqrt(squares.astype(np.float64)) * (1 - SLACK)
    return np.where(squares >= FAR, np.float32(np.inf), np.maximum(0, np.nextafter(root.astype(np.float32), np.float32(-np.inf))))


def reassign(x: np.ndarray, t: int, history: list[np.ndarray], groups: list[np.ndarray], state: np.ndarray) -> int:
    """Assign to the entries of round ``t``, bounds first; returns the number of exact distances computed.

    ``history[s]`` are the part's entries of round s.  ``state`` is updated in place: only bounds that were made exact
    get stamp ``t``, all others keep their round."""
    book = history[t]
    net = np.stack([np.sqrt(((book - old).astype(np.float64) ** 2).sum(1)) for old in history[:t + 1]]) * (1 + SLACK)
    far = np.zeros((t + 1, state["lower"].shape[1]))
    for g, members in enumerate(groups):
        far[:, g] = net[:, members].max(1)
    upper = state["upper"] + net[state["at"], state["code"]]
    lower = state["lower"].astype(np.float64) - far[state["stamp"], np.arange(far.shape[1])[None, :]]
    open_rows = np.flatnonzero(~(upper < lower.min(1)))
    if not len(open_rows):
        return 0
    state_rows, low, xs = state[open_rows], lower[open_rows], x[open_rows]
    a = state_rows["code"].astype(np.int64)
    own = ((xs - book[a]) ** 2).sum(1)
    exact = np.sqrt(own.astype(np.float64)) * (1 + SLACK)
    state_rows["at"], state_rows["upper"] = t, _up(np.sqrt(own))
    done = len(xs)
    best, code = own.copy(), a.copy()
    seconds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
    for g, members in enumerate(groups):
        r = np.flatnonzero(~(exact < low[:, g]))
        if not len(r):
            continue
        d = squared_distances(xs[r], book[members])
        done += d.size
        d[members[None, :] == a[r][:, None]] = FAR
        at = d.argmin(1)
        least = d[np.arange(len(r)), at]
        d[np.arange(len(r)), at] = FAR
        seconds[g] = (r, least, d.min(1), members[at])
        closer = (least < best[r]) | ((least == best[r]) & (members[at] < code[r]))
        best[r] = np.where(closer, least, best[r])
        code[r] = np.where(closer, members[at], code[r])
    moved = code != a
    for g, (r, least, second, entry) in seconds.items():
        state_rows["lower"][r, g] = _down(np.where(code[r] == entry, second, least))
        state_rows["stamp"][r, g] = t
    if moved.any():
        m = np.flatnonzero(moved)
        group_of = np.zeros(len(book), np.int64)
        for g, members in enumerate(groups):
            group_of[members] = g
        g = group_of[a[m]]  # the old entry is now one of the others of its group
        scanned = state_rows["stamp"][m, g] == t
        kept = np.where(scanned, state_rows["lower"][m, g].astype(np.float64), np.maximum(0, low[m, g]))
        state_rows["lower"][m, g] = np.minimum(np.nextafter(kept.astype(np.float32), np.float32(-np.inf)), _down(own[m]))
        state_rows["stamp"][m, g] = t
        state_rows["code"][m] = code[m]
        state_rows["upper"][m] = _up(np.sqrt(best[m]))
    state[open_rows] = state_rows
    return done


def _fixed_binary(rows: np.ndarray) -> pa.Array:
    """A binary value per row of a contiguous array."""
    raw = np.ascontiguousarray(rows)
    width = raw.nbytes // max(1, len(raw))
    offsets = np.arange(len(raw) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _fixed_rows(column: pa.Array, dtype: np.dtype, width: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int64)[column.offset]
    return np.frombuffer(data, dtype, len(column) * width, int(start)).reshape(len(column), width).copy()


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    """Integer components of a list column, padded with zeros to ``length``."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = integers(column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(column), length), np.int64)
    owner = np.repeat(np.arange(len(column)), sizes)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _round(t: int, books: Codebooks, length: int, number: str):
    """One round over batches: rows with their new state, then a row with the task's sums by part and entry."""
    dtype, width = state_type(), length // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = books.history[0].shape[1]
        sums, counts = np.zeros((PARTS, k, width), np.int64), np.zeros((PARTS, k), np.int64)
        done, names = 0, None
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                kept = [batch.column(0), batch.column(1)]
                names, types = batch.schema.names[:2], [batch.column(0).type, batch.column(1).type]
                if t == 0:
                    x = _vectors(batch.column(2), length)
                    state = np.zeros((batch.num_rows, PARTS), dtype)
                else:
                    x = _fixed_rows(batch.column(2), np.dtype(number), length).astype(np.int64)
                    state = _fixed_rows(batch.column(3), dtype, PARTS)
                parts = x.reshape(len(x), PARTS, width)
                for p in range(PARTS):
                    if t == 0:
                        done += first_scan(parts[:, p], books.history[0][p], books.groups[p], state[:, p])[1]
                    else:
                        done += reassign(parts[:, p], t, [h[p] for h in books.history], books.groups[p], state[:, p])
                    code = state["code"][:, p]
                    order = np.argsort(code, kind="stable")
                    used, first = np.unique(code[order], return_index=True)
                    sums[p][used] += np.add.reduceat(parts[order, p], first, axis=0)
                    counts[p] += np.bincount(code, minlength=k)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*kept, _fixed_binary(x.astype(number)), _fixed_binary(state), pa.nulls(n, pa.list_(pa.int64()))],
                                                 names=[*names, "x", "state", "sums"])
        if names:
            total = np.concatenate([sums.ravel(), counts.ravel(), [done]])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, types[0]), pa.nulls(1, types[1]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                              pa.array([total.tolist()], pa.list_(pa.int64()))], names=[*names, "x", "state", "sums"])
    return run


def _final(books: Codebooks, length: int, number: str):
    """Codes and errors with the last codebooks."""
    dtype, width, t = state_type(), length // PARTS, len(books.history) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                x = _fixed_rows(batch.column(2), np.dtype(number), length).astype(np.int64).reshape(-1, PARTS, width)
                state = _fixed_rows(batch.column(3), dtype, PARTS)
                error = np.zeros(len(x), np.int64)
                for p in range(PARTS):
                    reassign(x[:, p], t, [h[p] for h in books.history], books.groups[p], state[:, p])
                    error += ((x[:, p] - books.history[t][p][state["code"][:, p]]) ** 2).sum(1)
                digits = np.ascontiguousarray(state["code"]).tobytes().hex()
                codes = [digits[i:i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])
    return run


def kept_rows(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    return rows.where(F.col("vector").isNotNull() & ~bad)


def _train(rows: DataFrame, rounds: int, entries: int) -> tuple[Codebooks, DataFrame, int, str] | None:
    """The codebooks and the table of (vec_id, label, x, state); None if there is no row."""
    top = F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0.0))
    facts = rows.agg(F.max(F.size("vector")).alias("length"), F.max(top).alias("top")).first()
    if facts["length"] is None:
        return None
    length = max(PARTS, -(-facts["length"] // PARTS) * PARTS)
    number = "<i2" if facts["top"] * SCALE < 32_000 else "<i4"
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()  # at most 256 rows
    book = np.zeros((PARTS, len(start), length // PARTS), np.int64)
    for i, row in enumerate(start):
        x = np.zeros(length, np.int64)
        x[:len(row["vector"])] = integers(np.array(row["vector"], np.float64))
        book[:, i] = x.reshape(PARTS, -1)
    books = Codebooks([book], entry_groups(book), [])
    fields = rows.schema.fields[:2]
    schema = StructType([*fields, *StructType.fromDDL("x binary, state binary, sums array<long>").fields])
    table = rows
    for t in range(rounds):
        written = shared_table(table.mapInArrow(_round(t, books, length, number), schema), "codes")
        sums = {r["pos"]: r["total"] for r in written.where("sums IS NOT NULL").select(F.posexplode("sums").alias("pos", "value"))
                .groupBy("pos").agg(F.sum("value").alias("total")).collect()}  # entries x components
        total = np.array([sums[i] for i in range(len(sums))], np.int64)
        cells, k = book.size, book.shape[1]
        counts = total[cells:cells + PARTS * k].reshape(PARTS, k, 1)
        mean = total[:cells].reshape(book.shape) // np.maximum(1, counts)
        book = np.where(counts > 0, mean, books.history[-1])
        books.history.append(book)
        books.evaluations.append(int(total[-1]))
        table = written.where("sums IS NULL").select("vec_id", "label", "x", "state")
    return books, table, length, number


def train(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS,
          entries: int = ENTRIES) -> Codebooks | None:
    trained = _train(kept_rows(vectors, vec_id, vector, label), rounds, entries)
    return trained and trained[0]


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS,
             entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part."""
    rows = kept_rows(vectors, vec_id, vector, label)
    trained = _train(rows, rounds, entries)
    schema = StructType([*rows.schema.fields[:2], StructField("code", StringType()), StructField("error", LongType())])
    if trained is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books, table, length, number = trained
    coded = shared_table(table.mapInArrow(_final(books, length, number), schema).withColumn("key", F.struct("label")), "coded")
    totals = shared_table(coded.groupBy("key").agg(F.sum("error").alias("label_error")), "label-errors")
    return look_up(coded, totals, "key").select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle() -> str:
    """The same by full scans in SQL: every part against every entry in each of the rounds."""
    parts = """WITH kept AS (SELECT vec_id, label, embedding AS v FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    part AS (SELECT vec_id, label, p, list_transform(v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)], lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
      FROM kept, (SELECT unnest(range(4)) AS p) positions),
    first_ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256) s),
    book0 AS (SELECT p, entry, x AS c FROM part JOIN first_ids USING (vec_id))"""
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT"
    for t in range(ROUNDS + 1):
        parts += f""",
    near{t} AS (SELECT vec_id, label, p, any_value(x) AS x, min({{'d': d, 'entry': entry}}) AS best FROM (
      SELECT vec_id, label, part.p, entry, x, {distance} AS d FROM part JOIN book{t} ON part.p = book{t}.p) pairs GROUP BY vec_id, label, p)"""
        if t < ROUNDS:
            parts += f""",
    mean{t} AS (SELECT p, entry, list(m ORDER BY i) AS c FROM (
      SELECT p, best.entry AS entry, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m FROM near{t}, (SELECT unnest(range(1, 17)) AS i) d GROUP BY p, best.entry, i) s
      GROUP BY p, entry),
    book{t + 1} AS (SELECT b.p, b.entry, coalesce(m.c, b.c) AS c FROM book{t} b LEFT JOIN mean{t} m ON b.p = m.p AND b.entry = m.entry)"""
    return parts + f""",
    coded AS (SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
      FROM near{ROUNDS} GROUP BY vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
      (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM book{ROUNDS}) AS codebooks_sha256 FROM coded"""
