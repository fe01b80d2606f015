"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two interpolated Kneser-Ney models of letters (contexts of up to ``CONTEXT`` letters, not beyond the
word) are learned from a bounded sample of labelled texts, one from the toxic and one from the
ordinary ones.  Contexts of two and more letters have counts of their own in each class; below
that both share the counts of all sampled texts, so a rare expression that neither class knows gets
nearly the same likelihood from both.  Both models are tabulated over one trie of contexts, and the
distinct words of a batch walk it side by side.

A text is compared by its toxic less its ordinary log-likelihood per word, over the whole text and
over its most telling words (the greatest one, and those above each bar of ``TELLING``, against its
length).  A logistic fit of these figures on the same sample gives the score.

Null and empty texts, and texts with no letter, get the score of no evidence.  Without sampled rows
of both classes every score is 0.  A document labelled both ways counts for both.  Rows with null
text or label are not learned from.  Extra columns are ignored; ``passthrough`` names those returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import hashed_sample_by_class, shared_table, with_fields
from binlens.llm.words import LetterWords, letter_numbers, letter_words, per_text, sub_batches

CONTEXT = 4
CLASS_CONTEXT = 2
DISCOUNT = 0.75
TELLING = (2.0, 3.0, 4.0, 6.0)
THRESHOLD = 0.7
# bound of the labelled sample: about so many texts per class, none of over LONG_TEXT characters
SAMPLE_TEXTS = 2_000
LONG_TEXT = 8_000
PART = 48
_LETTERS = 61  # frequent letters told apart; numbers: 1 other letters, 2 start of a word, 3 end of a word
_OTHER, _START, _END, _WIDTH = 1, 2, 3, 65


def sample_rows(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """label, text of about ``texts`` documents per class, chosen by a hash of the id; only labels are shuffled."""
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).distinct()
    chosen = shared_table(hashed_sample_by_class(marked, "label", "key", texts), "labelled-sample")
    # a few thousand ids, so within what Spark broadcasts
    texts_of = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))  # no other column can clash
    return texts_of.where(F.length("text") <= LONG_TEXT).join(chosen, "key").select("label", "text").limit(8 * texts)


@dataclass
class Model:
    number: np.ndarray    # of every code point
    blank: int
    follow: np.ndarray    # next context by context and letter
    evidence: np.ndarray  # toxic less ordinary log-likelihood of the letter
    start: int
    weights: np.ndarray | None = None

    def word_evidence(self, w: LetterWords) -> np.ndarray:
        """Evidence of every distinct spelling."""
        starts, lengths = w.starts[w.first], w.lengths[w.first]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state, total = np.full(len(starts), self.start, np.int64), np.zeros(len(starts), np.float64)
        for p in range(int(lengths.max(initial=0)) + 1):
            m = int(np.searchsorted(-lengths, -p, side="right"))
            c = np.where(lengths[:m] > p, w.stream[np.minimum(starts[:m] + p, len(w.stream) - 1)], _END)
            total[:m] += self.evidence[state[:m], c]
            state[:m] = self.follow[state[:m], c]
        out = np.empty(len(starts))
        out[order] = total
        return out

    def figures(self, texts: pa.Array) -> np.ndarray:
        """Of every text: evidence per word, greatest evidence of a word, and how many words tell how much."""
        w = letter_words(texts, self.number, self.blank, PART)
        e = self.word_evidence(w)[w.back]
        n = np.diff(w.ptr)
        top = np.zeros(len(n))
        has = n > 0
        if has.any():
            top[has] = np.maximum.reduceat(e, w.ptr[:-1][has])
        per = np.maximum(n, 1)
        above = [per_text((e > x).astype(np.int64), w.ptr) for x in TELLING]
        return np.stack([per_text(e, w.ptr) / per, np.log1p(np.maximum(top, 0)), *(a / np.sqrt(per) for a in above),
                         np.sqrt(above[2] / per)], axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        z = np.concatenate([self.figures(texts), np.ones((len(texts), 1))], axis=1) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _kneser_ney(words_of_class: list[tuple[LetterWords, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Tables over the trie of contexts from the spellings and their counts in each class."""
    letters, counts = [], []
    for k, (w, n) in enumerate(words_of_class):
        starts, lengths = w.starts[w.first], w.lengths[w.first]
        size = lengths + 2
        at = np.cumsum(size) - size
        flat = np.zeros(size.sum(), np.int64)
        flat[at], flat[at + size - 1] = _START, _END
        inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat[np.repeat(at + 1, lengths) + inner] = w.stream[np.repeat(starts, lengths) + inner]
        letters.append((flat, np.arange(len(flat)) - np.repeat(at, size), np.repeat(n, size)))
    # contexts of each length: the code holds the last letters, 7 bits each
    levels, grams = [], []
    for size in range(CONTEXT + 1):
        found = []
        for flat, place, n in letters:
            i = np.flatnonzero(place >= max(size, 1))
            code = np.zeros(len(i), np.int64)
            for back in range(size, 0, -1):
                code = code << 7 | flat[i - back]
            found.append((code, flat[i], n[i]))
        codes = np.unique(np.concatenate([f[0] for f in found]))
        levels.append(codes)
        table = np.zeros((2, len(codes), _WIDTH), np.float32)
        for k, (code, letter, n) in enumerate(found):
            np.add.at(table[k], (np.searchsorted(codes, code), letter), n)
        grams.append(table)
    suffix = [None] + [np.searchsorted(levels[s - 1], levels[s] & ((1 << 7 * (s - 1)) - 1)) for s in range(1, CONTEXT + 1)]
    probability: list[np.ndarray] = []
    for size in range(CONTEXT + 1):
        raw = grams[size]
        if size == CONTEXT:
            count = raw
        else:  # kinds of letters before; a context at the start of a word has none and keeps its count
            count = np.zeros_like(raw)
            for k in (0, 1):
                np.add.at(count[k], suffix[size + 1], grams[size + 1][k] > 0)
            if size:
                at_start = (levels[size] >> 7 * (size - 1)) == _START
                count[:, at_start] = raw[:, at_start]
        if size < CLASS_CONTEXT:
            count = np.repeat(count.sum(axis=0, keepdims=True), 2, axis=0)
        total = count.sum(axis=2, keepdims=True)
        kinds = (count > 0).sum(axis=2, keepdims=True).astype(np.float32)
        below = np.full((2, len(levels[size]), _WIDTH), 1 / _WIDTH, np.float32) if size == 0 else probability[-1][:, suffix[size]]
        probability.append(np.where(total > 0, (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * below) / np.maximum(total, 1), below))
    first = np.concatenate([[0], np.cumsum([len(x) for x in levels])])
    follow: list[np.ndarray] = []
    for size in range(CONTEXT + 1):
        if size:
            nxt = follow[size - 1][suffix[size]]
        else:
            nxt = np.zeros((1, _WIDTH), np.int64)
        if size < CONTEXT:
            code = (levels[size][:, None] << 7) | np.arange(_WIDTH)
            where = np.minimum(np.searchsorted(levels[size + 1], code), len(levels[size + 1]) - 1)
            nxt = np.where(levels[size + 1][where] == code, first[size + 1] + where, nxt)
        follow.append(nxt)
    evidence = np.concatenate([np.log(p[1]) - np.log(p[0]) for p in probability]).astype(np.float32)
    start = int(first[1] + np.searchsorted(levels[1], _START))
    return np.concatenate(follow).astype(np.int32), evidence, start


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps, classes weighted alike."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    b = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge @ b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(b)), gradient)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(texts_by_label: dict[int, list[str]]) -> Model | None:
    """The model of texts labelled 0 and 1; None unless there are both with a letter."""
    both = [sorted(set(texts_by_label.get(k, []))) for k in (0, 1)]
    frequent: dict[str, int] = {}
    for texts in both:
        for t in texts:
            for c in set(t.lower()):
                if c.isalpha():
                    frequent[c] = frequent.get(c, 0) + t.lower().count(c)
    if not all(any(c.isalpha() for t in texts for c in t) for texts in both):
        return None
    top = sorted(frequent, key=lambda c: (-frequent[c], c))[:_LETTERS]
    blank = _LETTERS + 10
    number = letter_numbers({ord(c): i + 4 for i, c in enumerate(top)}, blank)
    # fitted on one half, weighed on the other, then learned from all
    def learn(parts: list[list[str]]) -> Model:
        spelled = []
        for texts in parts:
            w = letter_words(pa.array(texts, pa.large_string()), number, blank, PART)
            spelled.append((w, np.bincount(w.back, minlength=len(w.first))))
        return Model(number, blank, *_kneser_ney(spelled))

    whole = learn(both)
    if min(map(len, both)) >= 4:
        x, y = [], []
        for side in (0, 1):
            model = learn([t[side::2] for t in both])
            for k in (0, 1):
                x.append(model.figures(pa.array(both[k][1 - side::2], pa.large_string())))
                y.append(np.full(len(x[-1]), k))
    else:
        x = [whole.figures(pa.array(t, pa.large_string())) for t in both]
        y = [np.full(len(f), k) for k, f in enumerate(x)]
    whole.weights = _logistic(np.concatenate(x), np.concatenate(y))
    return whole


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model | None:
    by: dict[int, list[str]] = {}
    for row in sample_rows(docs, labels, text, label, key).collect():  # at most SAMPLE_TEXTS per class
        by.setdefault(row["label"], []).append(row["text"])
    return train(by)


def score(docs: DataFrame, model: Model | None, text: str = "text", passthrough: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passthrough`` columns, score, predicted of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    rows = docs.select(*passthrough, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in sub_batches(batch, "__text"):
                s = np.zeros(part.num_rows) if model is None else model.score(part.column("__text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                    names=[*part.schema.names[:-1], "score", "predicted"])

    return rows.mapInArrow(run, with_fields(rows, "score double, predicted int"))
