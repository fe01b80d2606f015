"""Filter interaction audit by an incremental stream with retractions.

Five filters (A-E) judge whole texts; E fails a document whose text stands under a smaller id anywhere in the
table.  The files of the table are processed as available-now micro-batches.  Per text the state keeps
the smallest id seen so far and that id's rows.  When a smaller id arrives, the mask that was counted for the earlier rows is
retracted from their part's counters and counted again with E set; later rows with greater ids are counted with
E at once.  After the last batch the sum of all changes is the exact count of every mask in every part.

All figures follow from these counts.  ``kept`` after the filters of a set is the number of masks that
avoid the set; 32 such sums per part give every step of all 120 orders.  Over all orders a document's
removal is shared equally among the filters it fails, 120 / (their number) each (``shapley``).

**On Spark.**  A stateless pass reads the texts, leaving 16 bytes of digest and a mask; labels are joined by id; rows of equal texts are
combined within each task before the shuffle, so a text's copies arrive as one row per task, part and label.
State is keyed by a bucket of the digest (a fixed expected number of texts per bucket) and holds the texts as Arrow
data, since one call per text would cost more than the work itself.  State and progress are
checkpointed in the shared folder, changes go to a Parquet sink that commits each batch once.

**Defined cases.**  A null text is empty, a null source the empty part.  A null id is greater than every id.  Rows with
an equal id and text are alike: none of them fails E for the other.  Several labels of one id count as 1 if one is.
An empty table gives an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binlens.llm.common import shared_path, shared_table
from binlens.llm.words import per_text, raw_bytes, sub_batches, words

LETTERS = "ABCDE"
E = 16
ORDERS = ["".join(p) for p in permutations(LETTERS)]
MICRO_BATCHES = 4
TEXTS_PER_BUCKET = 4096
COMBINE = 200_000  # rows that a task combines at a time

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True


def masks(texts: pa.Array) -> np.ndarray:
    """Failed filters of A-D as bits, A the lowest."""
    w = words(texts)
    n_words = w.counts
    owner = w.doc_of_word()
    order = np.lexsort((w.hashes, owner))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (w.hashes[order][1:] != w.hashes[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(n_words))
    data, offsets = raw_bytes(texts)
    capitals = per_text(_CAPITAL[data].astype(np.int64), offsets)
    points = per_text(((data & 0xC0) != 0x80).astype(np.int64), offsets)
    symbols = per_text(_SYMBOL[data].astype(np.int64), offsets)
    return ((n_words < 200) * 1 + (100 * distinct < 50 * n_words) * 2 + (100 * capitals > 2 * points) * 4 + (symbols > 0) * 8).astype(np.int32)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sub_batches(batch, "text"):
            data, offsets = raw_bytes(part.column("text"))
            digests = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("part"), pa.array(digests, pa.binary()), pa.array(masks(part.column("text")))],
                                             names=["doc_id", "part", "digest", "mask"])


ROW = "bucket int, digest binary, no_id boolean, id long, part string, mask int, good int, toxic int, holder boolean, n long"
KEYS = ["digest", "part", "mask", "good", "toxic"]


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of equal texts combined: per text the rows of its smallest id (``holder``) and those of greater ids.

    ``rows``: no_id, id, holder, n and KEYS; ids of rows that are no holders do not matter any more."""
    held = rows[rows["holder"]]
    first = held.sort_values(["no_id", "id"], kind="stable").drop_duplicates("digest")[["digest", "no_id", "id"]]
    least = held.merge(first.rename(columns={"no_id": "least_no_id", "id": "least_id"}), on="digest", how="left")
    least["holder"] = (least["no_id"] == least["least_no_id"]) & (least["id"] == least["least_id"])
    every = pd.concat([least[["no_id", "id", "holder", "n", *KEYS]], rows.loc[~rows["holder"], ["no_id", "id", "holder", "n", *KEYS]]])
    every.loc[~every["holder"], ["no_id", "id"]] = [False, 0]
    return every.groupby([*KEYS, "no_id", "id", "holder"], as_index=False, sort=False, dropna=False)["n"].sum()


def _combine(buckets: int):
    def batch_of(rows: pd.DataFrame) -> pa.RecordBatch:
        out = settle(rows)
        first = np.array([int.from_bytes(d[:7], "little") for d in out["digest"]], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array((first % buckets).astype(np.int32)), pa.array(out["digest"].tolist(), pa.binary()), pa.array(out["no_id"].astype(bool)),
             pa.array(out["id"].astype(np.int64)), pa.array(out["part"].tolist(), pa.string()), pa.array(out["mask"].astype(np.int32)),
             pa.array(out["good"].astype(np.int32)), pa.array(out["toxic"].astype(np.int32)), pa.array(out["holder"].astype(bool)),
             pa.array(out["n"].astype(np.int64))],
            names=["bucket", "digest", "no_id", "id", "part", "mask", "good", "toxic", "holder", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch.to_pandas().assign(holder=True, n=1))
            size += batch.num_rows
            if size >= COMBINE:
                yield batch_of(pd.concat(held))
                held, size = [], 0
        if size:
            yield batch_of(pd.concat(held))
    return run


def changes(old: pd.DataFrame, new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The state after ``new`` rows arrive, and what changes in the counters (part, mask, good, toxic, n).

    ``old`` holds the rows of each text's smallest id so far."""
    after = settle(pd.concat([old, new]) if len(old) else new)

    def counted(rows: pd.DataFrame, sign: int) -> pd.DataFrame:
        out = rows[["part", "good", "toxic"]].copy()
        out["mask"] = rows["mask"] + E * ~rows["holder"]
        out["n"] = sign * rows["n"]
        return out

    # all that was counted for the old rows is retracted; what stays is cancelled out by the sum
    moved = pd.concat([counted(after, 1), counted(old, -1)]) if len(old) else counted(after, 1)
    delta = moved.groupby(["part", "mask", "good", "toxic"], as_index=False, dropna=False)["n"].sum()
    return after[after["holder"]], delta[delta["n"] != 0]


STATE_COLUMNS = ["no_id", "id", "holder", "n", *KEYS]


def _update(key, groups, state):
    new = pd.concat([g for g in groups])
    old = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else pd.DataFrame(columns=STATE_COLUMNS)
    after, delta = changes(old, new[STATE_COLUMNS])
    table = pa.Table.from_pandas(after[STATE_COLUMNS], preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))
    yield delta[["part", "mask", "good", "toxic", "n"]]


def _as_glob(path: str) -> str:
    """The same path as a pattern: the stream's source takes a folder as it is, but a single file only by a pattern."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """part, mask, good, toxic, n of the documents in the files of ``path``, by a stream over the files."""
    still = spark.read.parquet(path)
    files = max(1, len(still.inputFiles()))
    buckets = max(1, -(-still.count() // TEXTS_PER_BUCKET))
    one = shared_table(labels.select(F.col("doc_id").cast("long").alias("label_id"), "quality", "toxic").where("label_id IS NOT NULL").groupBy("label_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")), "labels")
    stream = spark.readStream.schema(still.schema).option("maxFilesPerTrigger", -(-files // micro_batches)).parquet(_as_glob(path))
    judged = stream.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                           F.col("text").cast("string").alias("text")).mapInArrow(_judge, "doc_id long, part string, digest binary, mask int")
    # rows without an id look for a label id that no label has; they are spread by their digest
    keyed = judged.withColumns({"no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0).cast("long")),
                                "salt": F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(0)})
    labelled = keyed.join(one.withColumn("label_salt", F.lit(0).cast("long")), (F.col("id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    rows = labelled.select("no_id", "id", "part", "digest", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    out = rows.mapInArrow(_combine(buckets), ROW).groupBy("bucket").applyInPandasWithState(
        _update, "part string, mask int, good int, toxic int, n long", "texts binary", "append", "NoTimeout")
    sink = shared_path(spark, "audit-changes")
    run = (out.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
           .option("checkpointLocation", shared_path(spark, "audit-progress")).start(sink))
    run.awaitTermination()
    return spark.read.schema("part string, mask int, good int, toxic int, n long").parquet(sink).groupBy("part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n")).where("n <> 0")


def _orders() -> Column:
    """All 600 steps: order, step, the sets of filters before and after it, the position of its letter."""
    steps = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            bit = LETTERS.index(letter)
            after = before | 1 << bit
            steps.append(f"named_struct('filter_order', '{order}', 'step', {step}, 'before', {before}, 'after', {after}, 'letter', {bit})")
            before = after
    return F.expr(f"array({', '.join(steps)})")


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of masks."""
    mask, n = F.col("mask"), F.col("n")

    def total(condition: Column, weight: Column = n) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("long")

    def per_set(flag: Column) -> Column:
        return F.array(*[total((mask.bitwiseAND(s) == 0) & flag) for s in range(32)])

    failing = [mask.bitwiseAND(1 << bit) != 0 for bit in range(5)]
    share = n * 120 / F.bit_count(mask)
    parts = counts.groupBy("part").agg(
        per_set(F.lit(True)).alias("kept_of"), per_set(F.col("good") == 1).alias("good_of"), per_set(F.col("toxic") == 1).alias("toxic_of"),
        F.array(*[total(f) for f in failing]).alias("fails_of"), F.array(*[total(mask == 1 << bit) for bit in range(5)]).alias("unique_of"),
        F.array(*[total(f, share) for f in failing]).alias("shapley_of"))
    at = parts.select("*", F.explode(_orders()).alias("o")).select("*", "o.*")

    def lost(name: str) -> Column:
        return F.get(name, F.col("before")) - F.get(name, F.col("after"))

    removed = lost("kept_of")
    return at.select("part", "filter_order", "step", F.get("kept_of", F.col("after")).alias("kept"), removed.alias("removed"),
                     (F.get("fails_of", F.col("letter")) - removed).alias("redundant"), F.get("unique_of", F.col("letter")).alias("unique_fails"),
                     lost("good_of").alias("good_lost"), lost("toxic_of").alias("toxic_lost"), F.get("shapley_of", F.col("letter")).alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """part, filter_order, step and the counts, for the documents in the files of ``path``."""
    return report(shared_table(mask_counts(spark, path, labels, micro_batches), "mask-counts"))


ORACLE = r"""WITH judged AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failed AS (
  SELECT part, doc_id, (len(w) < 200) AS A, (100 * len(list_distinct(w)) < 50 * len(w)) AS B,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)) AS C, regexp_matches(text, '[#$%&*|]') AS D,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), min(doc_id) OVER (PARTITION BY text) IS NOT NULL) AS E FROM judged),
labelled AS (
  SELECT f.*, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS bad,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END) AS fails
  FROM failed f LEFT JOIN labels l USING (doc_id)),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6))::INT AS step) s),
seen AS (SELECT l.part, s.filter_order, s.step, s.f, len(l.fails) AS n_fails, good, bad, list_contains(l.fails, s.f) AS hit,
  len(list_filter(l.fails, lambda x: contains(s.earlier, x))) > 0 AS gone FROM labelled l, steps s),
counted AS (SELECT part, filter_order, step, f,
  count(*) FILTER (NOT gone AND NOT hit) AS kept, count(*) FILTER (NOT gone AND hit) AS removed, count(*) FILTER (gone AND hit) AS redundant,
  count(*) FILTER (hit AND n_fails = 1) AS unique_fails, count(*) FILTER (NOT gone AND hit AND good) AS good_lost,
  count(*) FILTER (NOT gone AND hit AND bad) AS toxic_lost FROM seen GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted"""
