"""Queries over bundled applications: format, segments, metadata, chunks, hints."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import bundle as U
from binlens.plans.registry import query

_WS = U.WS
_FMT = [(f, lang, p) for f, lang, p in C.BUNDLE_FORMATS if p]
_FLAGS = ", ".join(f"bool_or(regexp_matches(s, '{p}')) AS {f}" for f, _, p in _FMT)
_FMT_CASE = " ".join(f"WHEN coalesce(fl.{f}, false) THEN '{f}'" for f, _, _ in _FMT)
_LANG_CASE = " ".join(f"WHEN coalesce(fl.{f}, false) THEN '{lang}'" for f, lang, _ in _FMT)

SEG_RE2 = r"(?:[^\p{C}\p{Z}]|[ \n\r\t]){%d,}" % (C.SEGMENT_MIN_LEN + 1)
_BUILTIN = " OR ".join(f"contains(segment, '{m}')" for m in C.BUILTIN_SEGMENT_MARKERS)

SEG_CTE = f"""
segs AS (SELECT doc_id AS bundle_id, unnest(m) AS segment, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS seg_no
         FROM (SELECT doc_id, regexp_extract_all(text, '{SEG_RE2}', 0) AS m FROM documents) d),
segc AS (SELECT bundle_id, seg_no, segment, CAST(length(segment) AS INTEGER) AS n_chars,
                CASE WHEN {_BUILTIN} THEN 'builtin' ELSE 'app' END AS seg_class FROM segs)
"""

_BREAK = "^" + _WS + "*" + C.CHUNK_BREAK_PATTERN[1:]
_LIT = C.SOURCE_LITERAL
_ERR = " OR ".join(f"contains(lower(lit), '{w}')" for w in C.HINT_ERROR_WORDS)
_URL = "contains(lit, '/') AND (" + " OR ".join(f"contains(lit, '{w}')" for w in C.HINT_URL_WORDS) + ")"
_KW = " OR ".join(f"contains(lower(lit), '{w}')" for w in C.HINT_KEYWORDS)

CHUNK_CTE = f"""
cand AS (SELECT bundle_id, line_no - 1 AS i FROM fx_bundle_lines
         WHERE line_no > 1 AND regexp_matches(text, '{_BREAK}')),
nodes AS (SELECT bundle_id, i FROM cand UNION SELECT DISTINCT bundle_id, 0 FROM fx_bundle_lines),
nxt AS (SELECT n.bundle_id, n.i, min(c.i) AS nxt FROM nodes n
        LEFT JOIN cand c ON c.bundle_id = n.bundle_id AND c.i >= n.i + {U.STEP} GROUP BY ALL),
chain(bundle_id, i) AS (SELECT DISTINCT bundle_id, 0 FROM fx_bundle_lines
        UNION ALL SELECT x.bundle_id, x.nxt FROM chain JOIN nxt x ON x.bundle_id = chain.bundle_id AND x.i = chain.i
        WHERE x.nxt IS NOT NULL),
total AS (SELECT bundle_id, count(*) AS total_lines FROM fx_bundle_lines GROUP BY 1),
ranges AS (SELECT c.bundle_id, CAST(row_number() OVER w - 1 AS INTEGER) AS idx, c.i AS start_i,
                  coalesce(lead(c.i) OVER w, t.total_lines) AS end_i
           FROM chain c JOIN total t USING (bundle_id) WINDOW w AS (PARTITION BY c.bundle_id ORDER BY c.i)),
ls AS (SELECT bundle_id, line_no - 1 AS i, text, length(text) + 1 AS len1,
              length(regexp_replace(text, '^{_WS}+', '')) = 0 AS blank,
              length(text) - length(regexp_replace(text, '^{_WS}+', '')) AS lead_ws,
              length(text) - length(regexp_replace(text, '{_WS}+$', '')) AS trail_ws FROM fx_bundle_lines),
asg AS (SELECT ls.*, r.idx, r.start_i, r.end_i FROM ls JOIN ranges r
        ON r.bundle_id = ls.bundle_id AND ls.i >= r.start_i AND ls.i < r.end_i),
ends AS (SELECT bundle_id, idx, min(i) AS fi, max(i) AS li, arg_min(lead_ws, i) AS lead_f, arg_max(trail_ws, i) AS trail_l
         FROM asg WHERE NOT blank GROUP BY ALL),
chars AS (SELECT a.bundle_id, a.idx, sum(a.len1) - e.lead_f - e.trail_l - 1 AS chars
          FROM asg a JOIN ends e USING (bundle_id, idx) WHERE a.i BETWEEN e.fi AND e.li
          GROUP BY a.bundle_id, a.idx, e.lead_f, e.trail_l),
chunks AS (SELECT r.bundle_id, r.idx, printf('chunk_%03d_L%d-L%d.js', r.idx, r.start_i + 1, r.end_i) AS file,
                  CAST(r.start_i + 1 AS INTEGER) AS start_line, CAST(r.end_i AS INTEGER) AS end_line,
                  CAST(r.end_i - r.start_i AS INTEGER) AS lines, CAST(coalesce(c.chars, 0) AS INTEGER) AS chars
           FROM ranges r LEFT JOIN chars c USING (bundle_id, idx) WHERE coalesce(c.chars, 0) >= {C.CHUNK_MIN_CHARS}),
hl AS (SELECT bundle_id, idx, regexp_extract_all(string_agg(text, chr(10) ORDER BY i), '{_LIT}', 1) AS lits
       FROM asg JOIN chunks USING (bundle_id, idx) GROUP BY ALL),
firsts AS (SELECT bundle_id, idx, list_filter(lits, lambda lit: {_ERR})[1:{C.HINT_LIMIT}] AS hint_errors,
                  list_filter(lits, lambda lit: {_URL})[1:{C.HINT_LIMIT}] AS hint_urls,
                  list_filter(lits, lambda lit: {_KW})[1:{C.HINT_LIMIT}] AS hint_keywords FROM hl)
"""


@query("bundle_format", f"""
WITH fl AS (SELECT binary_id, {_FLAGS} FROM fx_format_strings GROUP BY 1),
bn AS (SELECT binary_id, bool_or(contains(segment_name, '{C.BUN_SEGMENT}')) AS bun FROM fx_segments GROUP BY 1),
ids AS (SELECT binary_id FROM fx_format_strings UNION SELECT binary_id FROM fx_segments)
SELECT ids.binary_id, CASE WHEN coalesce(bn.bun, false) THEN 'bun' {_FMT_CASE} ELSE 'native' END AS bundled_format,
       CASE WHEN coalesce(bn.bun, false) THEN 'javascript' {_LANG_CASE} END AS bundled_language
FROM ids LEFT JOIN bn USING (binary_id) LEFT JOIN fl USING (binary_id)
""")
def bundle_format(inp):
    return U.bundle_format(inp.table("fx_format_strings"), inp.table("fx_segments"))


def _segments(inp):
    return U.text_segments(inp.base("documents"), id_col="doc_id")


@query("text_segments", f"""
WITH {SEG_CTE}
SELECT bundle_id, seg_no, n_chars, seg_class, md5(segment) AS seg_md5 FROM segc
""")
def text_segments(inp):
    """X13 + P11 over the documents table, each text taken as a decoded payload."""
    return _segments(inp).select("bundle_id", "seg_no", "n_chars", "seg_class", F.md5("segment").alias("seg_md5"))


_VER_RE2 = U.VERSION_RE
_COPY_RE2 = U.COPYRIGHT_RE.replace("(?d)", "")
_NAME_RE2 = U.APP_NAME_RE


def _grab(pat, strip):
    v = f"regexp_extract(head, '{pat}', 1)"
    if strip:
        v = f"regexp_replace({v}, '^{_WS}+|{_WS}+$', '', 'g')"
    return f"CASE WHEN regexp_matches(head, '{pat}') THEN {v} END"


REGISTRY_METADATA_SQL = f"""
WITH __SEG_CTE__,
head AS (SELECT bundle_id, string_agg(segment, chr(10) ORDER BY seg_no) AS head
         FROM (SELECT * FROM segc WHERE seg_class = 'app') s
         GROUP BY 1),
meta AS (SELECT bundle_id, {_grab(_VER_RE2, False)} AS app_version, {_grab(_COPY_RE2, True)} AS copyright,
                {_grab(_NAME_RE2, True)} AS app_name FROM head),
tot AS (SELECT bundle_id,
               CAST(sum(CASE WHEN seg_class = 'app' THEN n_chars ELSE 0 END) AS BIGINT) AS app_chars,
               CAST(sum(CASE WHEN seg_class = 'builtin' THEN n_chars ELSE 0 END) AS BIGINT) AS builtin_chars,
               count(*) FILTER (WHERE seg_class = 'app') AS app_segments,
               count(*) FILTER (WHERE seg_class = 'builtin') AS builtin_segments FROM segc GROUP BY 1)
SELECT tot.*, meta.app_version, meta.copyright, meta.app_name FROM tot LEFT JOIN meta USING (bundle_id)
"""


@query("bundle_metadata", REGISTRY_METADATA_SQL.replace("__SEG_CTE__", SEG_CTE))
def bundle_metadata(inp):
    return U.bundle_metadata(_segments(inp))


@query("declaration_chunks", f"WITH RECURSIVE {CHUNK_CTE} SELECT * FROM chunks")
def declaration_chunks(inp):
    return U.declaration_chunks(inp.table("fx_bundle_lines"))


HINTS_SQL = f"""
WITH RECURSIVE {CHUNK_CTE}
SELECT c.bundle_id, c.idx, coalesce(array_to_string(f.hint_errors, ' | '), '') AS hint_errors,
       coalesce(array_to_string(f.hint_urls, ' | '), '') AS hint_urls,
       coalesce(array_to_string(f.hint_keywords, ' | '), '') AS hint_keywords
FROM chunks c LEFT JOIN firsts f ON f.bundle_id = c.bundle_id AND f.idx = c.idx
"""


def _hints(lines):
    hints = U.chunk_hints(lines, U.declaration_chunks(lines))
    return hints.withColumns({k: F.coalesce(F.array_join(k, " | "), F.lit("")) for k in U.HINT_KINDS})


@query("chunk_hints", HINTS_SQL)
def chunk_hints(inp):
    return _hints(inp.table("fx_bundle_lines"))


@query("chunk_hints_over_lines", HINTS_SQL.replace("fx_bundle_lines", "fx_bundle_cut_lines"))
def chunk_hints_over_lines(inp):
    """X16 where literals run over line breaks."""
    return _hints(inp.table("fx_bundle_cut_lines"))


@query("chunk_document_lines", f"""
WITH RECURSIVE {CHUNK_CTE}
SELECT bundle_id, idx, file, CAST(0 AS BIGINT) AS pos,
       printf('// Chunk %d: lines %d-%d of app_beautified.js', idx, start_line, end_line) AS text FROM chunks
UNION ALL
SELECT a.bundle_id, a.idx, c.file, CAST(a.i - a.start_i + 1 AS BIGINT) AS pos, a.text
FROM asg a JOIN chunks c ON a.bundle_id = c.bundle_id AND a.idx = c.idx
""")
def chunk_document_lines(inp):
    """The documents of the kept chunks, line by line under their header."""
    lines = inp.table("fx_bundle_lines")
    return U.chunk_document_lines(lines, U.cut_lineage(U.declaration_chunks(lines)))


@query("chunk_documents", f"""
WITH RECURSIVE {CHUNK_CTE}
SELECT bundle_id, idx, md5(string_agg(text, chr(10) ORDER BY i)) AS content_md5 FROM asg JOIN chunks USING (bundle_id, idx)
GROUP BY ALL
""")
def chunk_documents(inp):
    """The text of every kept chunk."""
    lines = inp.table("fx_bundle_lines")
    return U.chunk_documents(lines, U.declaration_chunks(lines)).select("bundle_id", "idx", F.md5("content").alias("content_md5"))


@query("chunk_index_summary", f"""
WITH RECURSIVE {CHUNK_CTE}
SELECT t.bundle_id, t.total_lines, coalesce(n.chunks, 0) AS chunks,
       t.total_lines // greatest(coalesce(n.chunks, 0), 1) AS avg_lines
FROM total t LEFT JOIN (SELECT bundle_id, count(*) AS chunks FROM chunks GROUP BY 1) n USING (bundle_id)
""")
def chunk_index_summary(inp):
    lines = inp.table("fx_bundle_lines")
    return U.chunk_index_summary(lines, U.declaration_chunks(lines))


PAYLOAD_SEG_CTE = SEG_CTE.replace("doc_id AS bundle_id", "payload_id AS bundle_id").replace(
    "SELECT doc_id, regexp_extract_all", "SELECT payload_id, regexp_extract_all").replace(
    "FROM documents", "FROM fx_bundle_payloads")


def _payload_segments(inp):
    return U.text_segments(inp.table("fx_bundle_payloads"), id_col="payload_id")


@query("payload_segments", f"""
WITH {PAYLOAD_SEG_CTE}
SELECT bundle_id, seg_no, n_chars, seg_class, md5(segment) AS seg_md5 FROM segc
""")
def payload_segments(inp):
    """X13 + P11 on payloads with builtin segments and control-character separators."""
    return _payload_segments(inp).select("bundle_id", "seg_no", "n_chars", "seg_class",
                                         F.md5("segment").alias("seg_md5"))


@query("payload_metadata", REGISTRY_METADATA_SQL.replace("__SEG_CTE__", PAYLOAD_SEG_CTE))
def payload_metadata(inp):
    """X14 on payloads that carry an app name, a version banner and a copyright line."""
    return U.bundle_metadata(_payload_segments(inp))
