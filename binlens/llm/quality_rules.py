"""Line-first cleaning: rules per line, then rejection of texts that lose too much.

Words are runs of characters outside ``\\x20\\x09-\\x0D``; a line is a ``\\n``-split part that has a
word.  A line fails when one of these holds:

* punctuation: no word of it ends a sentence (``.!?`` or a wide full stop, closing quotes or
  brackets may follow); or over a quarter of its words end in two marks of ``!?``; or its symbols
  ``#*$%&|<>`` outnumber a quarter of its words;
* navigation: at least two of its words, and 15 in 100 of them, are lone separators;
* boilerplate: it holds a phrase of ``BOILERPLATE`` (case of A-Z ignored), or equals an earlier line
  of the text, or 30 in 100 of its words equal the word before them.

A text is kept if the base rules hold (20 words; at most 30 in 100 of its words in 8-word windows
found twice) and the failing lines hold at most half of its words.  Every rule looks at the whole
text; nothing is capped.

Null and empty texts have no word and are rejected with counts of 0.  Repeated rows and ids are
judged one by one.  Extra columns are ignored; ``passthrough`` names those that are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import with_fields
from binlens.llm.words import U, mix, per_text, raw_bytes, span_hashes, sub_batches, windows, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST_PERCENT = 50
WINDOW = 8
SEPARATORS = ["|", ">", "<", "/", "-", "*", "•", "·", "»", "›", "→"]
BOILERPLATE = [
    "all rights reserved", "copyright ©", "(c) copyright", "licensed under the", "terms of use", "terms of service",
    "terms and conditions", "privacy policy", "cookie policy", "uses cookies", "accept cookies", "enable javascript",
    "javascript is disabled", "click here to", "subscribe to our", "sign up for our newsletter", "skip to content",
    "powered by wordpress", "lorem ipsum",
]
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_MARK, _CLOSER, _DOUBLE = (np.isin(np.arange(256), list(s)) for s in (b".!?", b"\"')]", b"!?"))
_WIDE = np.array([int.from_bytes(c.encode(), "big") for c in "…。！？"])
_SEPARATOR_HASHES = np.sort(words(pa.array(SEPARATORS)).hashes)


def judge(texts: pa.Array) -> dict[str, np.ndarray | list]:
    """Base counts, verdict and the text without its failing lines, for every text of an Arrow column."""
    w = words(texts)
    n_docs, data, offsets = len(w.ptr) - 1, w.data, w.offsets
    doc = w.doc_of_word()
    n_words = w.counts
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out = {"n_words": n_words, "word_chars": per_text(points[w.ends] - points[w.starts], w.ptr),
           "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]]}

    hashes, first = windows(w, WINDOW, short_whole=False)
    key = mix(hashes + (doc[first].astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    twice = first[order[np.append(again, False) | np.append(False, again)]] if len(order) else first
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, np.minimum(twice + WINDOW, len(doc)), -1)
    out["n_repeat_words"] = per_text((np.cumsum(cover)[:-1] > 0).astype(np.int64), w.ptr)

    # lines that have a word
    breaks = np.flatnonzero(data == 10)
    line_no = np.searchsorted(breaks, w.starts)
    new = np.ones(len(doc), bool)
    new[1:] = (line_no[1:] != line_no[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    line_ptr = np.concatenate([head, [len(doc)]])
    line_doc, k = doc[head], line_no[head]
    padded = np.concatenate([[-1], breaks, [len(data)]])
    begin = np.maximum(offsets[line_doc], padded[k] + 1)
    end = np.minimum(offsets[line_doc + 1], padded[k + 1])
    size = np.diff(line_ptr)
    line_of_doc = np.searchsorted(line_doc, np.arange(n_docs + 1))

    key = mix(span_hashes(data, begin, end) + (line_doc.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
    repeated = np.ones(len(head), bool)
    repeated[np.unique(key, return_index=True)[1]] = False
    out["n_dup_lines"] = per_text(repeated.astype(np.int64), line_of_doc)

    last = [data[np.maximum(w.ends - i, 0)].astype(np.int64) * (w.ends - w.starts >= i) for i in (1, 2, 3)]
    stop = _MARK[last[0]] | (_CLOSER[last[0]] & _MARK[last[1]]) | np.isin(last[2] << 16 | last[1] << 8 | last[0], _WIDE)
    double = _DOUBLE[last[0]] & _DOUBLE[last[1]]
    same = np.zeros(len(doc), bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & ~new[1:]
    lone = np.isin(w.hashes, _SEPARATOR_HASHES)
    n_stop, n_double, n_same, n_lone = (per_text(x.astype(np.int64), line_ptr) for x in (stop, double, same, lone))
    fails = (n_stop == 0) | (4 * n_double > size) | (4 * (symbols[end] - symbols[begin]) > size)
    fails |= (n_lone >= 2) & (100 * n_lone >= 15 * size)
    fails |= repeated | (100 * n_same >= 30 * size)
    lowered = data.tobytes().lower()
    for phrase in BOILERPLATE:
        raw, at = phrase.encode(), lowered.find(phrase.encode())
        while at >= 0:
            line = np.searchsorted(begin, at, side="right") - 1
            if line >= 0 and at + len(raw) <= end[line]:
                fails[line] = True
            at = lowered.find(raw, at + 1)

    lost = per_text(np.where(fails, size, 0), line_of_doc)
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
    out["lost_words"] = lost
    out["kept"] = ~out["base_failed"] & (100 * lost <= MAX_LOST_PERCENT * n_words)
    out["lines"] = (line_of_doc, begin, end, fails)
    return out


def cleaned_texts(texts: pa.Array, judged: dict) -> pa.Array:
    """Each text without its failing lines; a text without any stays as it is."""
    line_of_doc, begin, end, fails = judged["lines"]
    whole = texts.to_pylist()
    data, _ = raw_bytes(texts)
    bad = per_text(fails.astype(np.int64), line_of_doc)
    for i in np.flatnonzero(bad):
        at = [j for j in range(line_of_doc[i], line_of_doc[i + 1]) if not fails[j]]
        whole[i] = b"\n".join(data[begin[j]:end[j]].tobytes() for j in at).decode("utf-8", "replace")
    return pa.array(whole, pa.string())


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def clean(docs: DataFrame, text: str = "text", passthrough: tuple[str, ...] = ("doc_id",),
          with_text: bool = False) -> DataFrame:
    """``passthrough`` columns, the base counts, base_failed, kept, lost_words; cleaned_text if asked for."""
    rows = docs.select(*passthrough, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, "__text"):
                texts = part.column("__text")
                j = judge(texts)
                cols = [*part.columns[:-1], *(pa.array(j[c], pa.int64()) for c in COUNTS), pa.array(j["base_failed"]),
                        pa.array(j["kept"]), pa.array(j["lost_words"], pa.int64())]
                names = [*part.schema.names[:-1], *COUNTS, "base_failed", "kept", "lost_words"]
                if with_text:
                    cols.append(cleaned_texts(texts, j))
                    names.append("cleaned_text")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(run, with_fields(rows, f"{counts}, base_failed boolean, kept boolean, lost_words long"
                                            + ", cleaned_text string" * with_text))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice WHERE c > 1) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS no FROM d),
l AS (SELECT rid, no, line, list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS lw FROM raw),
f AS (SELECT rid, len(lw) AS n, row_number() OVER (PARTITION BY rid, line ORDER BY no) > 1 AS dup,
             len(list_filter(lw, lambda x: regexp_matches(x, '([.!?]["'')\\]]?|[…。！？])$'))) AS n_stop,
             len(list_filter(lw, lambda x: regexp_matches(x, '[!?][!?]$'))) AS n_double,
             len(line) - len(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS n_sym,
             len(list_filter(lw, lambda x: list_contains({_sql_list(SEPARATORS)}, x))) AS n_lone,
             len(list_filter(range(2, len(lw) + 1), lambda i: lw[i] = lw[i - 1])) AS n_same,
             len(list_filter({_sql_list(BOILERPLATE)}, lambda x: contains(lower(line), x))) > 0 AS boiler
      FROM l WHERE len(lw) > 0),
j AS (SELECT rid, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS n_dup_lines,
             sum(CASE WHEN n_stop = 0 OR 4 * n_double > n OR 4 * n_sym > n OR (n_lone >= 2 AND 100 * n_lone >= 15 * n)
                           OR dup OR 100 * n_same >= 30 * n OR boiler THEN n ELSE 0 END) AS lost_words
      FROM f GROUP BY rid),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(lost_words, 0) AS BIGINT) AS lost_words
      FROM w LEFT JOIN j ON j.rid = w.rid LEFT JOIN rep ON rep.rid = w.rid)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost_words <= 50 * n_words AS kept
FROM b
"""
