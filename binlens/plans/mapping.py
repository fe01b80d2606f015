"""Queries of the function -> source mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.operators import mapping as M
from binlens.operators import reports as R
from binlens.operators import text as X
from binlens.plans.registry import query
from binlens.plans.sqlparts import ALIASES_SQL, FULL_MAP_CTE, MAP_CTE
from binlens.session import cut_lineage


def _first(inp):
    """Written, since every query here reads it more than once and the definitions cost a scan of all text."""
    return cut_lineage(X.first_posting(X.source_definitions(inp.source_lines())))


def _direct(inp, first=None):
    return M.direct_matches(inp.functions(), _first(inp) if first is None else first, inp.table("in_demangled"))


def _cands(inp):
    def find():
        lits = X.function_literals(inp.decompiled())
        return cut_lineage(lits.join(_direct(inp).select("binary_id", F.col("name").alias("func_name")),
                                     ["binary_id", "func_name"], "left_anti")
                           .join(M.binary_trees(inp.functions()), ["binary_id"]))
    return inp.derived("anchor_candidates", find)


def _evidence(inp):
    lines = inp.source_lines()
    return M.anchor_evidence(_cands(inp), lines, X.source_literals(lines))


def _all_mappings(inp):
    return inp.derived("all_mappings", lambda: M.map_functions(
        inp.functions(), inp.call_graph(), inp.decompiled(), inp.source_lines(), inp.table("in_demangled")))


EV_COLS = ["binary_id", "tree_id", "func_name", "entry_address", "pos", "k", "r", "file", "line", "overwrite"]


def _flat_evidence(df):
    return df.select("binary_id", "tree_id", "func_name", "entry_address", "seq.pos", "seq.k",
                     F.col("seq.r").cast("bigint").alias("r"), "file", "line", "overwrite")


@query("direct_symbol_match", f"WITH {MAP_CTE} SELECT * FROM j1")
def direct_symbol_match(inp):
    return _direct(inp).where(F.col("match_method") == "direct_symbol")


@query("demangled_symbol_match", f"WITH {MAP_CTE} SELECT * FROM j2")
def demangled_symbol_match(inp):
    return _direct(inp).where(F.col("match_method") == "demangled_symbol")


@query("path_ref_match", f"WITH {MAP_CTE} SELECT * FROM pev")
def path_ref_match(inp):
    return _flat_evidence(_evidence(inp)).where(F.col("k") == 0)


@query("literal_match", f"WITH {MAP_CTE} SELECT * FROM lev")
def literal_match(inp):
    return _flat_evidence(_evidence(inp)).where(F.col("k") == 1)


@query("anchor_arbitrate", f"WITH {MAP_CTE} SELECT * FROM anch")
def anchor_arbitrate(inp):
    return M.arbitrate(_evidence(inp))


@query("enclosing_definition", f"WITH {MAP_CTE} SELECT * FROM encl")
def enclosing_definition(inp):
    anchors = M.arbitrate(_evidence(inp))
    return M.enclosing_definition(anchors, inp.source_lines())


@query("string_anchor_match", f"WITH {MAP_CTE} SELECT * FROM m1")
def string_anchor_match(inp):
    return M.string_anchor_matches(inp.functions(), inp.decompiled(), inp.source_lines(), _direct(inp))


@query("callee_candidates", f"""
WITH {MAP_CTE}
SELECT c.binary_id, c.tree_id, c.name AS caller_name, k.line_no, k.pos, k.cname AS cand_name,
       f.def_file, f.def_line, f.def_lang
FROM mm0 c JOIN calls k ON k.tree_id = c.tree_id AND k.rel_path = c.source_file
 AND k.line_no BETWEEN greatest(1, c.source_line - 4) AND c.source_line + 50 AND k.end_line <= c.source_line + 50
JOIN first_def f ON f.tree_id = c.tree_id AND f.name = k.cname
""")
def callee_candidates(inp):
    first = _first(inp)
    direct = cut_lineage(_direct(inp, first))
    stage12 = direct.unionByName(
        M.string_anchor_matches(inp.functions(), inp.decompiled(), inp.source_lines(), direct)
        .select(*M.MAP_COLS))
    return M.callee_candidates(stage12, M.known_calls(inp.source_lines(), first)).drop("caller_key")


@query("call_graph_propagate", f"WITH {FULL_MAP_CTE} SELECT * FROM mmx")
def call_graph_propagate(inp):
    return _all_mappings(inp)


@query("function_map_full", f"""
WITH {FULL_MAP_CTE}
SELECT f.binary_id, f.name AS ghidra_function_name, f.entry_address AS ghidra_address, m.source_file,
       m.source_line, m.confidence, m.match_method, m.original_name, m.source_language
FROM fn f JOIN mmx m ON m.binary_id = f.binary_id AND m.name = f.name
""")
def function_map_full(inp):
    return M.function_map(inp.functions(), _all_mappings(inp))


@query("helper_aliases", f"WITH {FULL_MAP_CTE} {ALIASES_SQL}")
def helper_aliases(inp):
    return M.helper_aliases(_all_mappings(inp))


@query("sorted_aliases", f"WITH {FULL_MAP_CTE} {ALIASES_SQL} ORDER BY ghidra_name, original_name")
def sorted_aliases(inp):
    """K4: aliases sorted by (ghidra_name, original_name) as the alias file lists them."""
    return M.helper_aliases(_all_mappings(inp)).orderBy("ghidra_name", "original_name")


@query("mapping_stats", f"""
WITH {FULL_MAP_CTE},
al AS ({ALIASES_SQL})
SELECT t.binary_id, t.total_functions, coalesce(m.n, 0) AS mapped_functions,
       round(coalesce(m.n, 0) / greatest(t.total_functions, 1) * 100, 2) AS coverage_percent,
       coalesce(a.n, 0) AS aliases
FROM (SELECT binary_id, count(*) AS total_functions FROM fn GROUP BY 1) t
LEFT JOIN (SELECT binary_id, count(*) AS n FROM mmx GROUP BY 1) m USING (binary_id)
LEFT JOIN (SELECT binary_id, count(*) AS n FROM al GROUP BY 1) a USING (binary_id)
""")
def mapping_stats(inp):
    return M.mapping_stats(inp.functions(), _all_mappings(inp))


@query("mapping_breakdown", f"""
WITH {FULL_MAP_CTE}
SELECT binary_id, 'by_method' AS dimension, match_method AS value, count(*) AS n FROM mmx GROUP BY ALL
UNION ALL SELECT binary_id, 'by_confidence', confidence, count(*) FROM mmx GROUP BY ALL
UNION ALL SELECT binary_id, 'by_language', source_language, count(*) FROM mmx GROUP BY ALL
""")
def mapping_breakdown(inp):
    return M.mapping_breakdown(_all_mappings(inp))


_COUNTER = "(SELECT binary_id, string_agg(concat({0}, '=', n), ',' ORDER BY {0}) AS v FROM (SELECT binary_id, {0}, count(*) AS n FROM mmx GROUP BY ALL) x GROUP BY 1)"


@query("mapping_report", f"""
WITH {FULL_MAP_CTE}
SELECT t.binary_id, t.total_functions, m.n AS mapped_functions, a.v AS by_method, c.v AS by_confidence, l.v AS by_language
FROM (SELECT binary_id, count(*) AS total_functions FROM fn GROUP BY 1) t
LEFT JOIN (SELECT binary_id, count(*) AS n FROM mmx GROUP BY 1) m USING (binary_id)
LEFT JOIN {_COUNTER.format('match_method')} a USING (binary_id)
LEFT JOIN {_COUNTER.format('confidence')} c USING (binary_id)
LEFT JOIN {_COUNTER.format('source_language')} l USING (binary_id)
""")
def mapping_report(inp):
    """The nested record, its maps flattened here for the comparison only."""
    r = R.mapping_report(inp.functions(), _all_mappings(inp))

    def flat(name):
        return F.array_join(F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(name)
    return r.select("binary_id", "total_functions", "mapped_functions", flat("by_method"), flat("by_confidence"), flat("by_language"))
