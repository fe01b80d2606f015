"""Queries identifying the software of each binary from its strings and symbols."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import identify as I
from binlens.plans.registry import query


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MK = ", ".join(f"({i}, {_q(n)}, {j}, {_q(m)})" for i, (n, _, ms, _, _) in enumerate(C.KNOWN_SOFTWARE)
                for j, m in enumerate(ms))
_SW = ", ".join(f"({i}, {_q(n)}, {_q(u)}, {_q(h)}, {k})" for i, (n, u, _, k, h) in enumerate(C.KNOWN_SOFTWARE))
_IND = ", ".join(f"({_q(lang)}, {_q(x)})" for lang, xs in C.LANGUAGE_INDICATORS for x in xs)
_IND += ", " + ", ".join(f"('c', {_q(x)})" for x in C.C_INDICATORS)
_P = C.GITHUB_URL_PATTERNS
_V = [p for p, _ in C.VERSION_PATTERNS]
_BP = C.BUILD_PATH_PATTERNS
_TAGS = ", ".join(_q(t) for t in C.TAG_FORMATS)

ID_CTE = f"""
mk AS (SELECT * FROM (VALUES {_MK}) t(sw_rank, sw_name, marker_rank, marker)),
sw AS (SELECT * FROM (VALUES {_SW}) t(sw_rank, sw_name, sw_repo_url, sw_source_dir_hint, min_markers)),
ind AS (SELECT * FROM (VALUES {_IND}) t(language, indicator)),
s100 AS (SELECT * FROM fx_strings),
um AS (SELECT binary_id, ord, 0 AS pat_no, unnest(o) AS owner, unnest(r) AS repo, generate_subscripts(o, 1) AS m_pos
       FROM (SELECT binary_id, ord, regexp_extract_all(s, '{_P[0]}', 1) AS o, regexp_extract_all(s, '{_P[0]}', 2) AS r
             FROM s100) a
       UNION ALL
       SELECT binary_id, ord, 1, unnest(o), unnest(r), generate_subscripts(o, 1)
       FROM (SELECT binary_id, ord, regexp_extract_all(s, '{_P[1]}', 1) AS o, regexp_extract_all(s, '{_P[1]}', 2) AS r
             FROM s100) b),
um2 AS (SELECT binary_id, ord, pat_no, m_pos, concat(owner, '/', rtrim(repo, '.git')) AS repo FROM um
        WHERE concat(owner, '/', rtrim(repo, '.git')) NOT IN ({", ".join(_q(r) for r in C.IGNORE_REPOS)})),
rfirst AS (SELECT binary_id, repo, ord AS f_ord, pat_no AS f_pat, m_pos AS f_pos FROM um2
           QUALIFY row_number() OVER (PARTITION BY binary_id, repo ORDER BY ord, pat_no, m_pos) = 1),
rc AS (SELECT binary_id, repo, count(*) AS n_refs FROM um2 GROUP BY ALL),
toprepo AS (SELECT rc.binary_id, rc.repo, rc.n_refs, concat('https://github.com/', rc.repo, '.git') AS repo_url,
                   lower(split_part(rc.repo, '/', 2)) AS name,
                   concat('GitHub URL found: ', rc.repo, ' (', rc.n_refs, ' refs)') AS evidence
            FROM rc JOIN rfirst USING (binary_id, repo)
            QUALIFY row_number() OVER (PARTITION BY rc.binary_id ORDER BY rc.n_refs DESC, f_ord, f_pat, f_pos) = 1),
hits AS (SELECT DISTINCT s.binary_id, mk.sw_rank, mk.sw_name, mk.marker_rank, mk.marker
         FROM s100 s JOIN mk ON contains(s.s, mk.marker)),
per AS (SELECT binary_id, sw_rank, sw_name, count(*) AS n_markers, list(marker ORDER BY marker_rank) AS ms
        FROM hits GROUP BY ALL),
sigm AS (SELECT per.binary_id, per.sw_rank, per.sw_name, per.n_markers, sw.sw_repo_url, sw.sw_source_dir_hint,
                array_to_string(ms, ',') AS markers,
                concat('Signature match: ', per.sw_name, ' (', per.n_markers, ' markers: [',
                       array_to_string(list_transform(ms, lambda x: concat('''', x, '''')), ', '), '])') AS evidence
         FROM per JOIN sw USING (sw_rank, sw_name) WHERE per.n_markers >= sw.min_markers),
sigw AS (SELECT * FROM sigm QUALIFY row_number() OVER (PARTITION BY binary_id ORDER BY sw_rank) = 1),
vm AS (SELECT binary_id, ord, 0 AS pat_no, 'named' AS kind, lower(regexp_extract(s, '{_V[0]}', 1)) AS name_candidate,
              regexp_extract(s, '{_V[0]}', 2) AS version, s FROM s100 WHERE regexp_matches(s, '{_V[0]}')
       UNION ALL
       SELECT binary_id, ord, 1, 'named', lower(regexp_extract(s, '{_V[1]}', 1)), regexp_extract(s, '{_V[1]}', 2), s
       FROM s100 WHERE regexp_matches(s, '{_V[1]}')
       UNION ALL
       SELECT binary_id, ord, 2, 'version_only', NULL, regexp_extract(s, '{_V[2]}', 1), s
       FROM s100 WHERE regexp_matches(s, '{_V[2]}')),
vstop AS (SELECT binary_id, name_candidate AS stop_name, version AS stop_version, ord AS s_ord, pat_no AS s_pat
          FROM vm WHERE kind = 'named' AND name_candidate IN (SELECT sw_name FROM sw)
          QUALIFY row_number() OVER (PARTITION BY binary_id ORDER BY ord, pat_no) = 1),
vbare AS (SELECT v.binary_id, v.version AS bare_version,
                 concat('Version string: ', regexp_replace(v.s, '^\\s+|\\s+$', '', 'g')) AS bare_evidence
          FROM vm v LEFT JOIN vstop t USING (binary_id)
          WHERE v.kind = 'version_only' AND (t.s_ord IS NULL OR v.ord < t.s_ord OR (v.ord = t.s_ord AND v.pat_no < t.s_pat))
          QUALIFY row_number() OVER (PARTITION BY v.binary_id ORDER BY v.ord, v.pat_no) = 1),
fver AS (SELECT coalesce(t.binary_id, b.binary_id) AS binary_id, t.stop_name, t.stop_version, b.bare_version,
                b.bare_evidence, CASE WHEN t.stop_name IS NOT NULL
                                      THEN concat('Version string: ', t.stop_name, ' ', t.stop_version) END AS stop_evidence
         FROM vstop t FULL JOIN vbare b USING (binary_id)),
bp AS (SELECT DISTINCT binary_id, path,
              regexp_extract(regexp_extract(regexp_replace(path, '(/\\.?)+$', ''), '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1) AS ext
       FROM (SELECT binary_id, unnest(list_distinct(list_concat(list_concat(regexp_extract_all(s, '{_BP[0]}', 1),
                    regexp_extract_all(s, '{_BP[1]}', 1)), regexp_extract_all(s, '{_BP[2]}', 1)))) AS path FROM s100) x),
bph AS (SELECT binary_id, ext, count(*) AS n_paths FROM bp WHERE length(ext) > 0 GROUP BY ALL),
bps AS (SELECT n.binary_id, n.n_paths,
               concat('Build paths found: ', n.n_paths, ' paths, ', coalesce(h.n_ext, 0), ' extensions') AS evidence
        FROM (SELECT binary_id, count(*) AS n_paths FROM bp GROUP BY 1) n
        LEFT JOIN (SELECT binary_id, count(*) AS n_ext FROM bph GROUP BY 1) h USING (binary_id)),
sy AS (SELECT DISTINCT binary_id, symbol FROM fx_symbols),
fam AS (SELECT binary_id, count(*) FILTER (WHERE starts_with(symbol, '{C.NAPI_PREFIX}')) AS napi_count,
               count(*) FILTER (WHERE starts_with(symbol, '{C.UV_PREFIX}')) AS uv_count,
               count(*) FILTER (WHERE contains(lower(symbol), 'node')) AS node_count FROM sy GROUP BY 1),
fam2 AS (SELECT *, CASE WHEN napi_count > {C.NAPI_MIN} THEN concat('N-API symbols: ', napi_count, ' (Node.js compatible runtime)') END AS napi_evidence,
                   CASE WHEN uv_count > {C.UV_MIN} THEN concat('libuv symbols: ', uv_count) END AS uv_evidence FROM fam),
lh AS (SELECT DISTINCT s.binary_id, ind.language FROM s100 s JOIN ind ON contains(s.s, ind.indicator)),
lang AS (SELECT binary_id,
                CASE WHEN count(*) FILTER (WHERE language <> 'c') > 0
                     THEN array_to_string(list_sort(list(language) FILTER (WHERE language <> 'c')), ',')
                     ELSE 'c' END AS languages
         FROM lh GROUP BY 1),
ids AS (SELECT binary_id FROM fx_strings UNION SELECT binary_id FROM fx_symbols),
idn0 AS (SELECT ids.binary_id, coalesce(v.stop_name, u.name, g.sw_name) AS name,
                coalesce(v.stop_version, v.bare_version) AS version,
                coalesce(u.repo_url, g.sw_repo_url) AS repo0, g.sw_source_dir_hint AS hint0,
                coalesce(l.languages, '') AS languages,
                list_filter([u.evidence, g.evidence, v.bare_evidence, v.stop_evidence, p.evidence, f.napi_evidence,
                             f.uv_evidence], lambda x: x IS NOT NULL) AS ev,
                coalesce(f.node_count, 0) AS node_count
         FROM ids LEFT JOIN toprepo u USING (binary_id) LEFT JOIN sigw g USING (binary_id)
         LEFT JOIN fver v USING (binary_id) LEFT JOIN bps p USING (binary_id) LEFT JOIN fam2 f USING (binary_id)
         LEFT JOIN lang l USING (binary_id)),
idn AS (SELECT i.binary_id, i.name, i.version, coalesce(i.repo0, sw.sw_repo_url) AS repo_url,
               coalesce(i.hint0, sw.sw_source_dir_hint) AS source_dir_hint, i.languages, i.ev,
               len(i.ev) AS n_evidence, i.node_count
        FROM idn0 i LEFT JOIN sw ON sw.sw_name = i.name),
idc AS (SELECT *, CASE WHEN name IS NOT NULL AND version IS NOT NULL AND repo_url IS NOT NULL AND n_evidence >= 3 THEN 'high'
                       WHEN name IS NOT NULL AND repo_url IS NOT NULL AND n_evidence >= 2 THEN 'medium'
                       WHEN name IS NOT NULL AND n_evidence >= 1 THEN 'low' ELSE 'none' END AS confidence FROM idn),
tcand AS (SELECT binary_id, name, version, repo_url, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS cand_pos,
                 replace(replace(unnest(f), '{{version}}', version), '{{name}}', name) AS tag
          FROM (SELECT *, [{_TAGS}] AS f FROM idc WHERE name IS NOT NULL AND version IS NOT NULL) x),
rtags AS (SELECT DISTINCT repo_url, rtrim(tag, '^{{}}') AS tag FROM fx_remote_tags),
tres AS (SELECT c.binary_id, c.tag FROM tcand c LEFT JOIN rtags r ON r.repo_url = c.repo_url AND r.tag = c.tag
         QUALIFY row_number() OVER (PARTITION BY c.binary_id ORDER BY r.tag IS NULL, c.cand_pos) = 1)
"""

ID_SELECT = """
SELECT idc.binary_id, idc.name, idc.version, idc.repo_url, tres.tag, idc.languages, idc.confidence,
       array_to_string(idc.ev, ' | ') AS evidence, idc.n_evidence, idc.source_dir_hint, idc.node_count
FROM idc LEFT JOIN tres USING (binary_id)
"""


def _software(inp):
    return C.software_catalog(inp.spark)


def _identity(inp):
    return I.identity(inp.strings(), inp.symbols(), _software(inp), inp.table("fx_remote_tags"))


@query("first_n_strings", f"""
SELECT binary_id, ord, s, CAST(row_number() OVER (PARTITION BY binary_id ORDER BY ord) AS INTEGER) AS rank
FROM fx_strings QUALIFY rank <= {C.FIRST_N_STRINGS}
""")
def first_n_strings(inp):
    """First-N cap after dense re-ranking."""
    return I.first_n(inp.strings(), C.FIRST_N_STRINGS)


@query("first_n_symbols", f"""
SELECT binary_id, ord, symbol, CAST(row_number() OVER (PARTITION BY binary_id ORDER BY ord) AS INTEGER) AS rank
FROM fx_symbols QUALIFY rank <= {C.FIRST_N_SYMBOLS}
""")
def first_n_symbols(inp):
    return I.first_n(inp.symbols(), C.FIRST_N_SYMBOLS)


@query("repo_urls", f"WITH {ID_CTE} SELECT binary_id, repo, n_refs FROM rc")
def repo_urls(inp):
    return I.repo_counts(I.repo_mentions(inp.strings())).select("binary_id", "repo", "n_refs")


@query("top_repo", f"WITH {ID_CTE} SELECT * FROM toprepo")
def top_repo(inp):
    return I.top_repo(I.repo_counts(I.repo_mentions(inp.strings())))


@query("signature_markers", f"""
WITH {ID_CTE}
SELECT binary_id, sw_rank, sw_name, n_markers, sw_repo_url, sw_source_dir_hint, markers, evidence FROM sigm
""")
def signature_markers(inp):
    return I.signature_markers(inp.strings(), _software(inp))


@query("version_mentions", f"WITH {ID_CTE} SELECT * FROM vm")
def version_mentions(inp):
    return I.version_mentions(inp.strings())


@query("first_version", f"WITH {ID_CTE} SELECT * FROM fver")
def first_version(inp):
    return I.first_version(I.version_mentions(inp.strings()), _software(inp))


@query("build_paths", f"WITH {ID_CTE} SELECT binary_id, path, ext FROM bp")
def build_paths(inp):
    return I.build_paths(inp.strings())


@query("build_path_extensions", f"WITH {ID_CTE} SELECT * FROM bph")
def build_path_extensions(inp):
    return I.build_path_extensions(I.build_paths(inp.strings()))


@query("symbol_families", f"WITH {ID_CTE} SELECT * FROM fam2")
def symbol_families(inp):
    return I.symbol_families(inp.symbols())


@query("binary_languages", f"WITH {ID_CTE} SELECT * FROM lang")
def binary_languages(inp):
    df = I.binary_languages(inp.strings())
    return df.select("binary_id", F.array_join("languages", ",").alias("languages"))


@query("identity_assemble", f"WITH {ID_CTE} {ID_SELECT}")
def identity_assemble(inp):
    return _identity(inp).withColumns({"languages": F.array_join("languages", ","), "evidence": F.array_join("evidence", " | ")})


@query("confidence_level", f"""
WITH {ID_CTE}
SELECT binary_id, name, version, repo_url, n_evidence, confidence FROM idc
""")
def confidence_level(inp):
    return _identity(inp).select("binary_id", "name", "version", "repo_url", "n_evidence", "confidence")


@query("catalog_fill", f"""
WITH {ID_CTE}
SELECT binary_id, name, repo_url, source_dir_hint FROM idc
""")
def catalog_fill(inp):
    return _identity(inp).select("binary_id", "name", "repo_url", "source_dir_hint")


@query("tag_candidates", f"WITH {ID_CTE} SELECT binary_id, name, version, repo_url, cand_pos, tag FROM tcand")
def tag_candidates(inp):
    base = I.identity(inp.strings(), inp.symbols(), _software(inp))
    return I.tag_candidates(base)


@query("resolve_tag", f"WITH {ID_CTE} SELECT * FROM tres")
def resolve_tag(inp):
    base = I.identity(inp.strings(), inp.symbols(), _software(inp))
    return I.resolve_tag(base, inp.table("fx_remote_tags"))
