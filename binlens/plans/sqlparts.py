"""DuckDB CTE texts shared by the oracles of the text and mapping queries.

They restate the operators in plain SQL over the fixture views: per-line regex
extraction, QUALIFY row_number() for "first", band joins as BETWEEN conditions, and
the propagation rounds unrolled.  ``ROUNDS`` is more than the fixtures need; a test checks that
the last one adds nothing.
"""

from __future__ import annotations

from binlens.functions import catalog as C


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _excluded(col: str, fragments) -> str:
    return "(" + " OR ".join(f"contains({col}, '{f}')" for f in fragments) + ")"


def _case(col: str, pairs, default: str = "NULL") -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in pairs) + f" ELSE {default} END"


EXT = r"regexp_extract(regexp_extract({c}, '([^/]*)$', 1), '^.+(\.[^.]+)$', 1)"
LANG_HPP = _case("ext", [(x, f"'{l}'") for x, l in C.DEFINITION_EXTENSIONS])
DEF_RANK = _case("ext", [(x, str(i)) for i, (x, _) in enumerate(C.DEFINITION_EXTENSIONS)])
LIT_RANK = _case("ext", [(x, str(i)) for i, x in enumerate(C.LITERAL_EXTENSIONS)])
DEF_NAME = _case("ext", [(x, f"regexp_extract(text, '{p}', 1)") for x, p in C.DEFINITION_PATTERNS.items()], "''")


def lang_no_hpp(col: str) -> str:
    pairs = [(x, f"'{l}'") for x, l in C.DEFINITION_EXTENSIONS if x != ".hpp"]
    return _case(EXT.format(c=col), pairs, "'unknown'")


DEF_EXTS = _in(x for x, _ in C.DEFINITION_EXTENSIONS)
EXCLUDED = _excluded("rel_path", C.EXCLUDED_FRAGMENTS)
NOT_NAMES = _in(C.NOT_DEFINITION_NAMES)
ROUNDS = 8

TEXT_CTE = f"""
src AS (SELECT tree_id, rel_path, line_no, text, {EXT.format(c='rel_path')} AS ext FROM in_source_lines),
defs AS (SELECT tree_id, rel_path, line_no, name, {LANG_HPP} AS lang, ext
         FROM (SELECT *, {DEF_NAME} AS name FROM src
               WHERE ext IN ({_in(x for x, _ in C.DEFINITION_EXTENSIONS)})
                 AND NOT {_excluded('rel_path', C.EXCLUDED_FRAGMENTS)}) d
         WHERE length(name) > 2 AND name NOT IN ({_in(C.NOT_DEFINITION_NAMES)})),
first_def AS (SELECT tree_id, name, rel_path AS def_file, line_no AS def_line, lang AS def_lang FROM defs
              QUALIFY row_number() OVER (PARTITION BY tree_id, name ORDER BY {DEF_RANK}, rel_path, line_no) = 1),
slit AS (SELECT tree_id, rel_path, line_no, ext, unnest(m) AS literal,
                CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos
         FROM (SELECT *, regexp_extract_all(text, '{C.SOURCE_LITERAL}', 1) AS m FROM src
               WHERE ext IN ({_in(C.LITERAL_EXTENSIONS)})
                 AND NOT {_excluded('rel_path', C.EXCLUDED_FRAGMENTS_LITERALS)}) s),
nonblank AS (SELECT tree_id, rel_path, line_no, text, lead(text) OVER w AS next_text, lead(line_no) OVER w AS next_line
             FROM src WHERE regexp_matches(text, '\\S') WINDOW w AS (PARTITION BY tree_id, rel_path ORDER BY line_no)),
calls AS (SELECT tree_id, rel_path, line_no, line_no AS end_line, unnest(m) AS cname,
                 CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos
          FROM (SELECT *, regexp_extract_all(text, '{C.CALL_SITE}', 1) AS m FROM src) s
          UNION ALL
          SELECT tree_id, rel_path, line_no, next_line, regexp_extract(text, '(\\w+)\\s*$', 1),
                 CAST(len(regexp_extract_all(text, '{C.CALL_SITE}', 1)) AS INTEGER)
          FROM nonblank WHERE regexp_matches(text, '\\w\\s*$') AND regexp_matches(next_text, '^\\s*\\(')),
flit AS (SELECT binary_id, func_name, entry_address, unnest(lits) AS literal,
                CAST(generate_subscripts(lits, 1) - 1 AS INTEGER) AS pos
         FROM (SELECT binary_id, func_name, entry_address,
                      list_concat(regexp_extract_all(text, '{C.FUNCTION_LITERAL}', 1),
                                  regexp_extract_all(text, '{C.PATH_LINE_REF}', 1)) AS lits
               FROM in_decompiled
               WHERE len(list_concat(regexp_extract_all(text, '{C.FUNCTION_LITERAL}', 1),
                                     regexp_extract_all(text, '{C.PATH_LINE_REF}', 1))) > 0
               QUALIFY row_number() OVER (PARTITION BY binary_id, func_name ORDER BY entry_address) = 1) f)
"""

MAP_CTE = TEXT_CTE + f""",
fn AS (SELECT * FROM in_functions),
fnames AS (SELECT binary_id, tree_id, name, min(entry_address) AS first_addr FROM fn
           WHERE NOT (starts_with(name, 'FUN_') OR starts_with(name, 'thunk_')) GROUP BY ALL),
j1 AS (SELECT n.binary_id, n.tree_id, n.name, f.def_file AS source_file, f.def_line AS source_line,
              'high' AS confidence, 'direct_symbol' AS match_method, f.name AS original_name,
              f.def_lang AS source_language, concat('0', n.first_addr, chr(1), n.name) AS order_key
       FROM fnames n JOIN first_def f ON f.tree_id = n.tree_id AND f.name = regexp_replace(n.name, '^_+', '')),
j2 AS (SELECT n.binary_id, n.tree_id, n.name, f.def_file AS source_file, f.def_line AS source_line,
              'medium' AS confidence, 'demangled_symbol' AS match_method, f.name AS original_name,
              f.def_lang AS source_language, concat('0', n.first_addr, chr(1), n.name) AS order_key
       FROM fnames n JOIN in_demangled d ON d.binary_id = n.binary_id AND d.name = n.name
       JOIN first_def f ON f.tree_id = n.tree_id
        AND f.name = trim(split_part(string_split(d.demangled_name, '::')[-1], '(', 1))
       WHERE d.demangled_name <> n.name AND length(d.demangled_name) > 0
         AND NOT EXISTS (SELECT 1 FROM j1 WHERE j1.binary_id = n.binary_id AND j1.name = n.name)),
m0 AS (SELECT * FROM j1 UNION ALL SELECT * FROM j2),
cands AS (SELECT l.*, t.tree_id FROM flit l JOIN (SELECT DISTINCT binary_id, tree_id FROM fn) t USING (binary_id)
          WHERE NOT EXISTS (SELECT 1 FROM m0 WHERE m0.binary_id = l.binary_id AND m0.name = l.func_name)),
files AS (SELECT DISTINCT tree_id, rel_path FROM src),
bybase AS (SELECT tree_id, regexp_extract(rel_path, '([^/]*)$', 1) AS base, min(rel_path) AS alt_path
           FROM files GROUP BY ALL),
refs AS (SELECT *, regexp_extract(literal, '{C.PATH_LINE_ANCHORED}', 1) AS ref_path,
                TRY_CAST(regexp_extract(literal, '{C.PATH_LINE_ANCHORED}', 2) AS BIGINT) AS ref_line
         FROM cands WHERE regexp_matches(literal, '{C.PATH_LINE_ANCHORED}')),
pev AS (SELECT c.binary_id, c.tree_id, c.func_name, c.entry_address, c.pos, 0 AS k, CAST(0 AS BIGINT) AS r,
               CASE WHEN fx.rel_path IS NOT NULL THEN c.ref_path ELSE b.alt_path END AS file,
               c.ref_line AS line, true AS overwrite
        FROM refs c
        LEFT JOIN files fx ON fx.tree_id = c.tree_id AND fx.rel_path = c.ref_path
        LEFT JOIN bybase b ON b.tree_id = c.tree_id AND b.base = regexp_extract(c.ref_path, '([^/]*)$', 1)
        WHERE (fx.rel_path IS NOT NULL OR b.alt_path IS NOT NULL) AND c.ref_line IS NOT NULL),
fpost AS (SELECT *, count(*) OVER (PARTITION BY tree_id, literal) AS n_postings FROM slit
          QUALIFY row_number() OVER (PARTITION BY tree_id, literal ORDER BY {LIT_RANK}, rel_path, line_no, pos) = 1),
lev AS (SELECT c.binary_id, c.tree_id, c.func_name, c.entry_address, c.pos, 1 AS k, CAST(1 AS BIGINT) AS r,
               r.rel_path AS file, CAST(r.line_no AS BIGINT) AS line, r.n_postings = 1 AS overwrite
        FROM cands c JOIN fpost r ON r.tree_id = c.tree_id AND r.literal = c.literal),
ev AS (SELECT * FROM pev UNION ALL SELECT * FROM lev),
fst AS (SELECT binary_id, tree_id, func_name, entry_address, file AS best_file, line AS first_line FROM ev
        QUALIFY row_number() OVER (PARTITION BY binary_id, tree_id, func_name, entry_address ORDER BY pos, k, r) = 1),
ow AS (SELECT e.binary_id, e.tree_id, e.func_name, e.entry_address, e.line AS ow_line
       FROM ev e JOIN fst f USING (binary_id, tree_id, func_name, entry_address)
       WHERE e.overwrite AND e.file = f.best_file
       QUALIFY row_number() OVER (PARTITION BY e.binary_id, e.tree_id, e.func_name, e.entry_address
                                  ORDER BY e.pos DESC, e.k DESC, e.r DESC) = 1),
anch AS (SELECT f.binary_id, f.tree_id, f.func_name, f.entry_address, f.best_file,
                coalesce(o.ow_line, f.first_line) AS best_line
         FROM fst f LEFT JOIN ow o USING (binary_id, tree_id, func_name, entry_address)),
wdefs AS (SELECT tree_id, rel_path, line_no,
                 CASE WHEN ext = '.zig' THEN regexp_extract(text, '{C.ENCLOSING_PATTERN_ZIG}', 1)
                      ELSE regexp_extract(text, '{C.ENCLOSING_PATTERN_OTHER}', 1) END AS def_name FROM src),
encl AS (SELECT a.binary_id, a.tree_id, a.func_name, a.entry_address, w.def_name AS enclosing_name
         FROM anch a JOIN wdefs w ON w.tree_id = a.tree_id AND w.rel_path = a.best_file
          AND w.line_no BETWEEN greatest(1, a.best_line - 19) AND a.best_line + 5
         WHERE length(w.def_name) > 0
         QUALIFY row_number() OVER (PARTITION BY a.binary_id, a.tree_id, a.func_name, a.entry_address
                                    ORDER BY w.line_no) = 1),
m1 AS (SELECT a.binary_id, a.tree_id, a.func_name AS name, a.best_file AS source_file, a.best_line AS source_line,
              CASE WHEN e.enclosing_name IS NOT NULL THEN 'high' ELSE 'medium' END AS confidence,
              'string_anchor' AS match_method, coalesce(e.enclosing_name, a.func_name) AS original_name,
              {lang_no_hpp('a.best_file')} AS source_language,
              concat('1', a.entry_address, chr(1), a.func_name) AS order_key
       FROM anch a LEFT JOIN encl e USING (binary_id, tree_id, func_name, entry_address)),
mm0 AS (SELECT * FROM m0 UNION ALL SELECT * FROM m1),
nedges AS (SELECT DISTINCT binary_id, caller_name, callee_name FROM in_call_graph)
"""


def round_cte(n: int, prev: str, out: str) -> str:
    """One propagation round: ``prev`` mappings -> ``out`` mappings."""
    r = f"r{n}"
    return f""",
{r}_callers AS MATERIALIZED (SELECT m.* FROM {prev} m WHERE EXISTS (
    SELECT 1 FROM nedges e WHERE e.binary_id = m.binary_id AND e.caller_name = m.name
      AND starts_with(e.callee_name, 'FUN_')
      AND NOT EXISTS (SELECT 1 FROM {prev} x WHERE x.binary_id = e.binary_id AND x.name = e.callee_name))),
{r}_offer AS MATERIALIZED (SELECT c.binary_id, c.tree_id, c.name AS caller, c.order_key AS caller_key, k.line_no, k.pos,
                     k.cname, f.def_file, f.def_line, f.def_lang
              FROM {r}_callers c JOIN calls k ON k.tree_id = c.tree_id AND k.rel_path = c.source_file
               AND k.line_no BETWEEN greatest(1, c.source_line - 4) AND c.source_line + 50
               AND k.end_line <= c.source_line + 50
              JOIN first_def f ON f.tree_id = c.tree_id AND f.name = k.cname
              WHERE NOT EXISTS (SELECT 1 FROM {prev} x WHERE x.binary_id = c.binary_id AND x.original_name = k.cname)
              QUALIFY row_number() OVER (PARTITION BY c.binary_id, c.name ORDER BY k.line_no, k.pos) = 1),
{r}_new AS MATERIALIZED (SELECT e.binary_id, o.tree_id, e.callee_name AS name, o.def_file AS source_file,
                   o.def_line AS source_line, 'low' AS confidence, 'callgraph_iter{n}' AS match_method,
                   o.cname AS original_name, o.def_lang AS source_language,
                   concat('2{n:06d}', o.caller_key, chr(2), e.callee_name) AS order_key
            FROM nedges e JOIN {r}_offer o ON o.binary_id = e.binary_id AND o.caller = e.caller_name
            WHERE starts_with(e.callee_name, 'FUN_')
              AND NOT EXISTS (SELECT 1 FROM {prev} x WHERE x.binary_id = e.binary_id AND x.name = e.callee_name)
            QUALIFY row_number() OVER (PARTITION BY e.binary_id, e.callee_name ORDER BY o.caller_key) = 1),
{out} AS MATERIALIZED (SELECT * FROM {prev} UNION ALL SELECT * FROM {r}_new)"""


FULL_MAP_CTE = MAP_CTE + "".join(round_cte(n, f"mm{n - 1}", f"mm{n}" if n < ROUNDS else "mmx") for n in range(1, ROUNDS + 1))

ALIASES_SQL = """
SELECT binary_id, name AS ghidra_name, original_name FROM mmx
WHERE (match_method = 'string_anchor' AND starts_with(name, 'FUN_') AND original_name <> name)
   OR starts_with(match_method, 'callgraph_iter')
"""
