"""Language-model scores from a hierarchical Pitman-Yor model sampled by Gibbs.

Tokens are the lower-cased (A-Z) words of a text and one end token.  Every context has a restaurant
whose customers are the training tokens seen in it; its tables are customers of the shared parent, the
unigram restaurant, whose base is diffuse: an unseen word is a new type and gets the mass of new
tables.  The context of a token is the word before it if that is one of the ``OWN_CONTEXTS`` most
frequent words of all training texts, else the class of that word's last letters, so the number of
restaurants is fixed; their customers are counted over all training texts.

Work is dealt by word: a bucket holds every context of its words, so the parent's counts of a word are
local, and only totals per context are shared.  The ``HOT_WORDS`` most frequent words are dealt by word and
context, and their totals are shared, too.  A text's tokens are counted per chunk of texts before they
are dealt.  In each sweep every bucket takes the customers of a context and word out and seats them again
one by one by the Chinese-restaurant rule, given the parent's probability and the shared totals
(after ``EXACT_SEATS`` customers, in spans with one binomial draw each).  The totals are summed after each
round; the last round averages the predictive probability over its sweeps.

Null and empty texts have the end token alone.  Null ids count as the empty text in the split.  Repeated
rows are scored one by one.  With no training text every token is unknown and has probability 1 in the
model.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import shared_table
from binlens.llm.packed import pack, unpack
from binlens.llm.words import U, Words, mix, sub_batches, words

OWN_CONTEXTS = 1000
ENDINGS = 1024
CONTEXTS = 1 + OWN_CONTEXTS + ENDINGS  # 0: start of a text
HOT_WORDS = 256
CHUNK_TOKENS = 1 << 19
CHUNK_TEXTS = 60_000
BUCKET_BYTES = 4 << 20  # of text, about 650,000 tokens
BUCKETS_PER_TASK = 8
HELD_SUMS = 1 << 20
ROUNDS = 2
BURN_IN = 2
SAMPLES = 3
EXACT_SEATS = 64
STRENGTH = 1.0
SEED = 23
END = mix(np.array([0xE4D], U))[0]
ADDED = 0.1


# ---- tokens ---------------------------------------------------------------------------------------------------
def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return first, np.diff(np.concatenate([first, [len(values)]]))


@dataclass
class Inventory:
    """Words with a restaurant of their own (sorted hashes and context numbers) and hot words (sorted hashes)."""

    own: np.ndarray
    number: np.ndarray
    hot: np.ndarray

    def hot_number(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the hot words, -1 for others."""
        if not len(self.hot):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        return np.where(self.hot[at] == hashes, at, -1)


def tokens(w: Words, inventory: Inventory) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context and text of every token; each text's words, then its end."""
    n, texts = len(w.hashes), len(w.ptr) - 1
    last = w.data[w.ends - 1].astype(np.int64)
    before = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0).astype(np.int64)
    third = np.where(w.ends - w.starts > 2, w.data[np.maximum(w.ends - 3, 0)], 0).astype(np.int64)
    context = 1 + OWN_CONTEXTS + (mix((last << 16 | before << 8 | third).astype(U)) % U(ENDINGS)).astype(np.int64)
    if len(inventory.own):
        at = np.minimum(np.searchsorted(inventory.own, w.hashes), len(inventory.own) - 1)
        context = np.where(inventory.own[at] == w.hashes, inventory.number[at], context)
    hashes = np.insert(w.hashes, w.ptr[1:], END)
    own_context = np.insert(context, w.ptr[1:], 0)  # nothing follows an end
    places = n + texts
    seen = np.zeros(places, np.int64)
    seen[1:] = own_context[:-1]
    return hashes, seen, np.repeat(np.arange(texts), w.counts + 1)


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word (its hash) occurs in all texts: (word, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.zeros(0, U), np.zeros(0, np.int64)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for part in sub_batches(batch, "text"):
                found, n = np.unique(words(part.column("text"), lower=True).hashes, return_counts=True)
                distinct, place = np.unique(np.concatenate([hashes, found]), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(distinct)).astype(np.int64)
                hashes = distinct
                if len(hashes) > HELD_SUMS:
                    yield row()
                    hashes, counts = hashes[:0], counts[:0]
        yield row()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def take_inventory(docs: DataFrame) -> Inventory:
    """The most frequent words of all texts; ties go to the smaller hash, read as signed."""
    top = [row["word"] % (1 << 64) for row in word_counts(docs).orderBy(F.desc("n"), "word").limit(OWN_CONTEXTS).collect()]
    own = np.sort(np.array(top, U))
    rank = {h: i + 1 for i, h in enumerate(top)}
    hot = np.sort(np.array([*top[:HOT_WORDS - 1], END], U))
    return Inventory(own, np.array([rank[h] for h in own.tolist()], np.int64), hot)


def _deal(inventory_shared, buckets: int):
    """Texts to rows (bucket, chunk, counts of word, context and text; the chunk's texts go with one of them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inventory: Inventory = inventory_shared.value
        chunk = TaskContext.get().partitionId() << 32  # the same when a task is run again
        held: list[tuple] = []
        ids: list = []
        out_of_training: list[bool] = []
        sizes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            hashes, context, text = (np.concatenate([h[i] for h in held]) for i in range(3))
            distinct, local = np.unique(hashes, return_inverse=True)
            key, times = np.unique(local << 28 | context << 16 | text, return_counts=True)
            word, context, text = key >> 28, key >> 16 & 0xFFF, key & 0xFFFF
            hot = inventory.hot_number(distinct)[word] >= 0
            bucket = (np.where(hot, mix(distinct[word] + context.astype(U)), distinct[word]) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            word, context, text, times, bucket = (x[order] for x in (word, context, text, times, bucket))
            first, length = runs(bucket)
            about = pack(np.array([-1 if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], np.uint8),
                         np.array(out_of_training, np.uint8), np.concatenate(sizes).astype(np.uint32))
            training = np.packbits(~np.array(out_of_training, bool))
            rows: list[list] = [[], [], [], []]
            for a, n in zip(first.tolist(), length.tolist()):
                s = slice(a, a + n)
                f, k = runs(word[s])
                g, m = runs(word[s] << 12 | context[s])
                per_word = np.diff(np.concatenate([np.searchsorted(g, f), [len(g)]]))
                rows[0].append(int(bucket[a]))
                rows[1].append(chunk)
                rows[2].append(pack(distinct[word[s][f]], per_word.astype(np.uint16), context[s][g].astype(np.uint16), m.astype(np.uint16),
                                    text[s].astype(np.uint16), times[s].astype(np.uint32), training))
                rows[3].append(None)
            rows[3][chunk % len(rows[3])] = about
            held.clear(), ids.clear(), out_of_training.clear(), sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()),
                                               pa.array(rows[3], pa.binary())], names=["bucket", "chunk", "counts", "about"])

        waiting = 0
        for batch in batches:
            for part in sub_batches(batch, "text", 1 << 20):
                w = words(part.column("text"), lower=True)
                hashes, context, text = tokens(w, inventory)
                if held and (len(ids) + part.num_rows > CHUNK_TEXTS or waiting + len(hashes) > CHUNK_TOKENS):
                    yield flush()
                    chunk, waiting = chunk + 1, 0
                held.append((hashes, context, text + len(ids)))
                ids += part.column("doc_id").to_pylist()
                out_of_training += part.column("held_out").to_pylist()
                sizes.append(w.counts + 1)
                waiting += len(hashes)
        if held:
            yield flush()
    return run


# ---- buckets --------------------------------------------------------------------------------------------------
# shared totals, in one array: per context tokens and tables, per hot word tokens and tables, then tokens, types of
# words that are not hot, tables of those words, pairs with one and with two tokens
_C, _T, _HC = 0, CONTEXTS, 2 * CONTEXTS
_HT = _HC + HOT_WORDS
_REST = _HT + HOT_WORDS
TOTALS = _REST + 5


@dataclass
class Bucket:
    tokens: np.ndarray    # training tokens of every pair of word and context
    context: np.ndarray
    word: np.ndarray      # place of the pair's word in the bucket, ascending
    hot: np.ndarray       # per word of the bucket, -1 if not hot
    pair: np.ndarray      # pair of every count
    chunk: np.ndarray     # place of its chunk among the bucket's chunks
    text: np.ndarray
    times: np.ndarray


def _gather(inventory_shared):
    def one(rows: list[tuple[int, bytes]], inventory: Inventory) -> tuple[bytes, np.ndarray]:
        parts = []
        for place, (_, raw) in enumerate(rows):
            distinct, per_word, context, per_pair, text, times, training = unpack(raw)
            n = per_pair.astype(np.int64)
            word = np.repeat(distinct, per_word.astype(np.int64))
            trained = np.unpackbits(training)[text].astype(np.int64)
            parts.append((np.repeat(word, n), np.repeat(context, n), np.full(len(text), place, np.uint32), text, times, times * trained))
        word, context, chunk, text, times, trained = (np.concatenate([p[i] for p in parts]) for i in range(6))
        del parts
        distinct, local = np.unique(word, return_inverse=True)
        key, pair = np.unique(local << 12 | context, return_inverse=True)
        tokens_of = np.bincount(pair, weights=trained, minlength=len(key)).astype(np.int64)
        order = np.argsort(pair, kind="stable")
        hot = inventory.hot_number(distinct)
        b = Bucket(tokens_of, key & 0xFFF, key >> 12, hot, pair[order], chunk[order], text[order], times[order])
        raw = pack(b.tokens.astype(np.uint32), b.context.astype(np.uint16), np.bincount(b.word, minlength=len(distinct)).astype(np.uint16),
                   b.hot.astype(np.int16), np.bincount(b.pair, minlength=len(key)).astype(np.uint32),
                   b.chunk.astype(np.uint16 if len(rows) < 65536 else np.uint32), b.text, b.times.astype(np.uint32), np.array([c for c, _ in rows], np.int64))
        return raw, first_totals(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inventory: Inventory = inventory_shared.value
        for bucket, rows in _grouped(batches, "bucket", ["chunk", "counts", "about"]):
            raw, totals = one([(c, x) for c, x, _ in rows], inventory)
            about = [(c, a) for c, _, a in rows if a is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int64()), pa.array([raw], pa.binary()), pa.array([totals.tolist()], pa.list_(pa.int64())),
                 pa.array([[{"chunk": c, "about": a} for c, a in about]], pa.list_(pa.struct([("chunk", pa.int64()), ("about", pa.binary())])))],
                names=["bucket", "counts", "totals", "about"])
    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str, columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of each key; they arrive sorted by it, and only one key's rows are held."""
    current, rows = None, []
    for k, *values in _rows(batches, key, *columns):
        if k != current:
            if rows:
                yield current, rows
            current, rows = k, []
        rows.append(tuple(values))
    if rows:
        yield current, rows


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows one by one: a batch of large values is never copied as a whole."""
    for batch in batches:
        read = [batch.column(c) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in read)


def read_bucket(raw: bytes) -> tuple[Bucket, np.ndarray]:
    tokens_of, context, per_word, hot, per_pair, chunk, text, times, chunks = unpack(raw)
    word = np.repeat(np.arange(len(per_word)), per_word.astype(np.int64))
    pair = np.repeat(np.arange(len(per_pair)), per_pair.astype(np.int64))
    return Bucket(tokens_of.astype(np.int64), context.astype(np.int64), word, hot.astype(np.int64), pair, chunk.astype(np.int64),
                  text.astype(np.int64), times.astype(np.int64)), chunks


def totals_of(b: Bucket, tables: np.ndarray) -> np.ndarray:
    out = np.zeros(TOTALS, np.int64)
    out[_C:_C + CONTEXTS] = np.bincount(b.context, weights=b.tokens, minlength=CONTEXTS)
    out[_T:_T + CONTEXTS] = np.bincount(b.context, weights=tables, minlength=CONTEXTS)
    hot = b.hot[b.word]
    is_hot = hot >= 0
    out[_HC:_HC + HOT_WORDS] = np.bincount(hot[is_hot], weights=b.tokens[is_hot], minlength=HOT_WORDS)
    out[_HT:_HT + HOT_WORDS] = np.bincount(hot[is_hot], weights=tables[is_hot], minlength=HOT_WORDS)
    of_word = np.bincount(b.word, weights=np.where(is_hot, 0, b.tokens), minlength=len(b.hot))
    out[_REST:] = [b.tokens.sum(), (of_word > 0).sum(), tables[~is_hot].sum(), (b.tokens == 1).sum(), (b.tokens == 2).sum()]
    return out


def first_totals(b: Bucket) -> np.ndarray:
    return totals_of(b, (b.tokens > 0).astype(np.int64))


@dataclass
class Shared:
    """Totals over all buckets, from the round before."""

    totals: np.ndarray

    def __post_init__(self):
        t = self.totals
        self.context_tokens, self.context_tables = t[_C:_T], t[_T:_HC]
        self.hot_tokens, self.hot_tables = t[_HC:_HT], t[_HT:_REST]
        self.tokens, rest_types, rest_tables, ones, twos = (int(x) for x in t[_REST:])
        self.types = rest_types + int((self.hot_tokens > 0).sum())
        self.customers = rest_tables + int(self.hot_tables.sum())  # of the unigram restaurant
        self.discount = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))
        self.unigram_discount = 0.75

    def unigram(self, tables: np.ndarray) -> np.ndarray:
        """Parent's probability of words with so many customers there; 0 customers: of an unseen word."""
        if not self.types:
            return np.ones(len(tables))
        new = STRENGTH + self.unigram_discount * self.types
        return np.where(tables > 0, tables - self.unigram_discount, new) / (STRENGTH + self.customers)

    def new_table(self) -> np.ndarray:
        """Weight of a new table, by context."""
        return STRENGTH + self.discount * self.context_tables


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of every pair after seating its customers one by one; ``weight``: of a new table, by the parent."""
    tables = (customers > 0).astype(np.int64)
    order = np.flatnonzero(customers > 1)
    order = order[np.argsort(-customers[order], kind="stable")]
    left, w, t, seated = customers[order], weight[order], np.ones(len(order)), 1
    while len(left) and left[0] > seated:
        span = 1 if seated < EXACT_SEATS else max(1, seated // 16)
        m = int(np.searchsorted(-left, -seated, side="left"))  # those with customers left
        p = w[:m] / (w[:m] + seated - discount * t[:m])
        t[:m] += random.random(m) < p if span == 1 else random.binomial(np.minimum(span, left[:m] - seated), p)
        seated += span
    tables[order] = t
    return tables


def sweeps(b: Bucket, s: Shared, bucket: int, round_: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tables of the pairs and the parent's probability of their words, sweep after sweep."""
    random = np.random.default_rng([SEED, bucket, round_])
    tables = (b.tokens > 0).astype(np.int64)
    is_hot = b.hot >= 0
    hot_tables = s.hot_tables[np.maximum(b.hot, 0)]
    new = s.new_table()[b.context]
    while True:
        mine = np.bincount(b.word, weights=tables, minlength=len(b.hot))
        parent = s.unigram(np.where(is_hot, hot_tables, mine))[b.word]
        yield tables, parent
        tables = seat(b.tokens, new * parent, s.discount, random)


def _round(shared, round_: int):
    """Totals after the burn-in sweeps of a round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, raw in _rows(batches, "bucket", "counts"):
            b, _ = read_bucket(raw)
            for n, (tables, _) in enumerate(sweeps(b, shared.value, bucket, round_)):
                if n == BURN_IN:
                    break
            yield pa.RecordBatch.from_arrays([pa.array([totals_of(b, tables).tolist()], pa.list_(pa.int64()))], names=["totals"])
    return run


def _score(shared):
    """Per chunk: texts, their known tokens, base score and model score, summed over the buckets of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Shared = shared.value
        held: dict[int, list[tuple]] = {}
        carried: dict[int, bytes] = {}
        waiting = 0

        def add_up() -> int:
            """One sum per text; returns how many there are."""
            for chunk, parts in held.items():
                if len(parts) > 1:
                    text, *values = (np.concatenate([p[i] for p in parts]) for i in range(4))
                    of, place = np.unique(text, return_inverse=True)
                    held[chunk] = [(of, *(np.bincount(place, weights=v, minlength=len(of)) for v in values))]
            return sum(len(parts[0][0]) for parts in held.values())

        def flush() -> pa.RecordBatch:
            add_up()
            # the base is exact, the model's own score is rounded
            rows = [(chunk, pack(text.astype(np.uint16), known.astype(np.uint32), base, score.astype(np.float32)), carried.get(chunk))
                    for chunk, [(text, known, base, score)] in held.items()]
            held.clear(), carried.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["chunk", "sums", "about"])

        for bucket, raw, about in _rows(batches, "bucket", "counts", "about"):
            b, chunks = read_bucket(raw)
            likely = np.zeros(len(b.tokens))
            new, of_context = s.new_table()[b.context], STRENGTH + s.context_tokens[b.context]
            for n, (tables, parent) in enumerate(sweeps(b, s, bucket, ROUNDS)):
                if n > BURN_IN:
                    likely += (np.maximum(b.tokens - s.discount * tables, 0) + new * parent) / of_context
                if n == BURN_IN + SAMPLES:
                    break
            tokens_of = np.where(b.hot >= 0, s.hot_tokens[np.maximum(b.hot, 0)],
                                 np.bincount(b.word, weights=b.tokens, minlength=len(b.hot)))
            base = np.log10((tokens_of + ADDED) / (s.tokens + ADDED * (s.types + 1)))[b.word]
            score = np.log10(likely / SAMPLES) if s.types else np.zeros(len(likely))
            known = (tokens_of > 0)[b.word]
            key, place = np.unique(b.chunk << 16 | b.text, return_inverse=True)
            sums = [np.bincount(place, weights=v[b.pair] * b.times, minlength=len(key)) for v in (known, base, score)]
            first, length = runs(key >> 16)
            carried.update((a["chunk"], a["about"]) for a in about)
            for a, n in zip(first.tolist(), length.tolist()):
                held.setdefault(int(chunks[key[a] >> 16]), []).append((key[a:a + n] & 0xFFFF, *(v[a:a + n].copy() for v in sums)))
            waiting += len(key)
            if waiting > HELD_SUMS:
                waiting = add_up()
                if waiting > HELD_SUMS // 2:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()
    return run


def _collect(train_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "chunk", ["sums", "about"]):
            ids, missing, held_out, size = unpack(next(a for _, a in rows if a is not None))
            known, base, score = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
            # a fixed order of the parts, so that sums are the same in every run
            for raw in sorted(r for r, _ in rows):
                text, *sums = unpack(raw)
                for total, part in zip((known, base, score), sums):
                    total[text] += part
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=missing.astype(bool)), pa.array(held_out.astype(bool)), pa.array(size.astype(np.int64)),
                 pa.array(known), pa.array(np.full(n, train_tokens, np.int64)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _summed(totals: DataFrame) -> np.ndarray:
    out = np.zeros(TOTALS, np.int64)
    for row in totals.select(F.posexplode("totals").alias("at", "n")).where("n <> 0").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]  # at most TOTALS rows
    return out


def score(docs: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text; rows that are not
    ``held_out`` are learned from."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0]
    if size is None:
        return spark.createDataFrame([], RESULT)
    buckets = max(1, -(-size // BUCKET_BYTES))
    inventory = spark.sparkContext.broadcast(take_inventory(rows.where(~F.col("held_out"))))
    dealt = rows.mapInArrow(_deal(inventory, buckets), "bucket long, chunk long, counts binary, about binary")
    gathered = shared_table(
        # a task takes some buckets, one after the other, and adds up their sums per text
        dealt.repartition(buckets, F.floor(F.col("bucket") / BUCKETS_PER_TASK)).sortWithinPartitions("bucket", "chunk").mapInArrow(
            _gather(inventory), "bucket long, counts binary, totals array<long>, about array<struct<chunk: long, about: binary>>"), "buckets")
    shared = spark.sparkContext.broadcast(Shared(_summed(gathered)))
    for r in range(ROUNDS):
        after = gathered.select("bucket", "counts").mapInArrow(_round(shared, r), "totals array<long>")
        shared = spark.sparkContext.broadcast(Shared(_summed(after)))
    parts = gathered.select("bucket", "counts", "about").mapInArrow(_score(shared), "chunk long, sums binary, about binary")
    return parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_collect(shared.value.tokens), RESULT)
