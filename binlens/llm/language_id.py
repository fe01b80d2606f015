"""Language identification by cross-parsing entropy over suffix automata.

Each language has a suffix automaton over the lower-cased letters of a bounded sample of its
labelled texts, one blank around every word.  A word is parsed greedily into the longest pieces
that the automaton accepts; a letter it does not know is a piece of its own.  A word costs its
number of pieces times log2 of the sample's length; the cost is normalised by the word's cost in
all languages together and weighted by its letters, so that no rare spelling outweighs the rest of
a text in two languages.  The language with the least normalised cost wins (ties: the first by
name).  Pieces never cross a word, so the distinct words of a batch are parsed side by side, one
letter of all of them at a time.

Nulls and texts with no letter give ``und`` with score 0.  Rows with null language are not learned
from.  With nothing to learn from, every text is ``und``.  Repeated rows and ids are kept as they
are.  Extra columns are ignored; ``passthrough`` names those that are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import hashed_sample_by_class, with_fields
from binlens.llm.words import letter_numbers, letter_words, per_text, sub_batches

UNKNOWN = "und"
# bounds of the labelled sample: texts and letters per language; texts of over LONG_TEXT characters are not taken
SAMPLE_TEXTS = 64
SAMPLE_LETTERS = 40_000
LONG_TEXT = 20_000
# bytes of text parsed at a time: the arrays of a part take many times its bytes
PARSED_BYTES = 1 << 19
# a longer word is parsed in parts of so many letters
PART = 48
# how often a letter's worth of normalised cost halves the odds of another language
HALVINGS_PER_LETTER = 4.0


def letters(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalpha())


class Automaton:
    """Suffix automaton; an edge is stored under ``state << 21 | code point``."""

    def __init__(self, text: str):
        self.size = max(2, len(text))
        edges: dict[int, int] = {}
        out: list[list[int]] = [[]]
        link, length, last = [-1], [0], 0
        for c in map(ord, text):
            cur = len(link)
            link.append(0)
            length.append(length[last] + 1)
            out.append([])
            p = last
            while p != -1 and (p << 21 | c) not in edges:
                edges[p << 21 | c] = cur
                out[p].append(c)
                p = link[p]
            if p != -1:
                q = edges[p << 21 | c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    out.append(list(out[q]))
                    for x in out[q]:
                        edges[twin << 21 | x] = edges[q << 21 | x]
                    while p != -1 and edges.get(p << 21 | c) == q:
                        edges[p << 21 | c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        self.edges = edges

    def table(self, alphabet: dict[int, int]) -> np.ndarray:
        """Next state by state and letter number; 0 stands for no edge (none leads to the root)."""
        keys = np.fromiter(self.edges.keys(), np.int64, len(self.edges))
        number = np.zeros(1 << 21, np.int64)
        number[list(alphabet)] = list(alphabet.values())
        out = np.zeros(((keys >> 21).max() + 2 + 2 * self.size, len(alphabet) + 2), np.int32)
        out = out[: max(int(max(self.edges.values())), int((keys >> 21).max())) + 1]
        out[keys >> 21, number[keys & ((1 << 21) - 1)]] = np.fromiter(self.edges.values(), np.int64, len(keys))
        return out


def sample_rows(labelled: DataFrame, text: str, lang: str, key: str, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """About ``texts`` labelled texts per language, chosen by a hash of the id; nothing but counts is shuffled."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return hashed_sample_by_class(rows.where(F.col("lang").isNotNull()), "lang", "key", texts).where(
        (F.length("text") <= LONG_TEXT) & F.col("text").rlike(r"\p{L}"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, Automaton]:
    """One automaton per language from the bounded sample (``SAMPLE_TEXTS``, ``SAMPLE_LETTERS``)."""
    by: dict[str, list[str]] = {}
    for row in sample_rows(labelled, text, lang, key).collect():  # at most four times SAMPLE_TEXTS per language
        by.setdefault(row["lang"], []).append(row["text"])
    models = {}
    for name in sorted(by):
        seen: dict[str, None] = {}
        total = 0
        for t in sorted(set(by[name])):
            for w in t.split():
                if (w := letters(w)) and w not in seen:
                    seen[w] = None
                    total += len(w) + 1
            if total >= SAMPLE_LETTERS:
                break
        if seen:
            models[name] = Automaton(" " + " ".join(seen) + " ")
    return models


class Parser:
    """Tables of all languages; letters are numbered 2.., 1 is a letter of no sample, 0 is none."""

    def __init__(self, models: dict[str, Automaton]):
        self.names = sorted(models)
        self.bits = np.array([math.log2(models[n].size) for n in self.names])
        letters_seen = sorted({k & ((1 << 21) - 1) for n in self.names for k in models[n].edges} | {32})
        alphabet = {c: i + 2 for i, c in enumerate(letters_seen)}
        self.blank = alphabet[32]
        self.tables = [models[n].table(alphabet) for n in self.names]
        self.number = letter_numbers(alphabet, self.blank)

    def pieces(self, letters_of: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Pieces per word and language; every word gets a blank before and after."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        result = np.zeros((len(starts), len(self.tables)), np.int64)
        steps = int(lengths[0]) + 2 if len(lengths) else 0
        active = [int(np.searchsorted(-lengths, -(p - 1), side="right")) for p in range(steps)]
        for k, table in enumerate(self.tables):
            state, n = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
            for p in range(steps):
                m = active[p]
                if p == 0:
                    c = np.full(m, self.blank, np.int64)
                else:
                    c = np.where(lengths[:m] >= p, letters_of[np.minimum(starts[:m] + p - 1, len(letters_of) - 1)], self.blank)
                now = state[:m]
                nxt = table[now, c]
                dead = nxt == 0
                n[:m] += dead & (now != 0)
                nxt = np.where(dead, table[0][c], nxt)
                n[:m] += nxt == 0
                state[:m] = nxt
            result[order, k] = n + (state != 0)
        return result

    def costs(self, texts: pa.Array) -> np.ndarray:
        """Of every text: letters, cost in bits in each language, normalised cost in each language."""
        w = letter_words(texts, self.number, self.blank, PART)
        pieces = self.pieces(w.stream, w.starts[w.first], w.lengths[w.first])
        cost = (pieces * self.bits)[w.back]
        lengths = w.lengths[:, None]
        share = cost / cost.sum(axis=1)[:, None] * lengths
        return per_text(np.concatenate([lengths, cost, share], axis=1), w.ptr)


def identify(docs: DataFrame, models: dict[str, Automaton], text: str = "text",
             passthrough: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passthrough`` columns, lang_pred, score, bits_per_letter (of the winner) of every whole text."""
    parser = Parser(models) if models else None
    shared = docs.sparkSession.sparkContext.broadcast(parser)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            for part in sub_batches(batch, "__text", PARSED_BYTES):
                rows = part.num_rows
                lang, score, rate = [UNKNOWN] * rows, np.zeros(rows), np.zeros(rows)
                if parser is not None:
                    sums = parser.costs(part.column("__text"))
                    n, k = sums[:, 0], len(parser.names)
                    bits, share = sums[:, 1:k + 1], sums[:, k + 1:]
                    best = share.argmin(axis=1)
                    lead = (share - share.min(axis=1)[:, None]) * HALVINGS_PER_LETTER
                    score = np.where(n > 0, 1 / np.exp2(-np.minimum(lead, 200)).sum(axis=1), 0.0)
                    rate = np.where(n > 0, bits[np.arange(rows), best] / np.maximum(n, 1), 0.0)
                    lang = [parser.names[b] if x else UNKNOWN for b, x in zip(best.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(rate)],
                    names=[*part.schema.names[:-1], "lang_pred", "score", "bits_per_letter"])

    kept = docs.select(*passthrough, F.col(text).cast("string").alias("__text"))
    return kept.mapInArrow(run, with_fields(kept, "lang_pred string, score double, bits_per_letter double"))
