"""Queries on produced source, plan tasks and run logs; plus the specified follow-up
steps (J16, J17, K6) that combine the mapping with the composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import compose as O
from binlens.operators import mapping as M
from binlens.operators import progress as P
from binlens.operators import text as X
from binlens.plans.composition import COMP_CTE
from binlens.plans.mapping import _all_mappings as all_mappings
from binlens.plans.registry import query
from binlens.plans.sqlparts import ALIASES_SQL, DEF_EXTS, DEF_NAME, EXCLUDED, EXT, FULL_MAP_CTE, NOT_NAMES

_PE = ", ".join(f"'{x}'" for x in C.PRODUCED_EXTENSIONS)

PROD_CTE = f"""
pl AS (SELECT tree_id, rel_path, line_no, text, {EXT.format(c='rel_path')} AS ext FROM in_produced_lines),
ptot AS (SELECT tree_id, count(DISTINCT rel_path) AS total_files, count(*) AS total_loc FROM pl
         WHERE ext IN ({_PE}) GROUP BY 1),
pfam AS (SELECT tree_id, family, count(*) FILTER (WHERE is_def) AS matches, bool_or(ext IN ('.c', '.cpp')) AS has_c
         FROM (SELECT *, CASE WHEN ext IN ('.cpp', '.c', '.h') THEN 'c_family' WHEN ext = '.zig' THEN 'zig'
                              WHEN ext IN ('.js', '.ts') THEN 'js_ts' END AS family,
                         CASE WHEN ext IN ('.cpp', '.c', '.h') THEN regexp_matches(text, '{C.C_DEFINITION_LINE}')
                              WHEN ext = '.zig' THEN regexp_matches(text, '{C.ZIG_DEFINITION_LINE}')
                              WHEN ext IN ('.js', '.ts') THEN regexp_matches(text, '{C.JS_DEFINITION_LINE}')
                              ELSE false END AS is_def FROM pl) x
         WHERE family IS NOT NULL GROUP BY ALL),
pdefs AS (SELECT tree_id, family, CASE WHEN family <> 'c_family' OR has_c THEN matches ELSE 0 END AS definitions FROM pfam),
pdtot AS (SELECT tree_id, CAST(sum(definitions) AS BIGINT) AS definitions FROM pdefs GROUP BY 1)
"""


def _produced(inp):
    return inp.table("in_produced_lines")


@query("definition_count", f"WITH {PROD_CTE} SELECT * FROM pdefs")
def definition_count(inp):
    return X.definition_line_counts(_produced(inp))


@query("source_totals", f"WITH {PROD_CTE} SELECT * FROM ptot")
def source_totals(inp):
    return P.source_totals(_produced(inp))


@query("quality_gates", f"""
WITH {PROD_CTE}
SELECT t.tree_id, t.total_files, t.total_loc, coalesce(d.definitions, 0) AS definitions,
       CASE WHEN t.total_files = 0 THEN 'A' WHEN t.total_loc < {C.GATE_MIN_LOC} THEN 'B'
            WHEN coalesce(d.definitions, 0) < {C.GATE_MIN_DEFINITIONS} THEN 'C' END AS failed_gate,
       NOT (t.total_files = 0 OR t.total_loc < {C.GATE_MIN_LOC} OR coalesce(d.definitions, 0) < {C.GATE_MIN_DEFINITIONS}) AS passed,
       CASE WHEN t.total_files = 0 THEN 'No source files found in output/src/.'
            WHEN t.total_loc < {C.GATE_MIN_LOC} THEN concat('QUALITY: Only ', t.total_loc, ' lines of code across ',
                 t.total_files, ' files. Minimum 500 LOC required.')
            WHEN coalesce(d.definitions, 0) < {C.GATE_MIN_DEFINITIONS}
                 THEN concat('QUALITY: Only ', coalesce(d.definitions, 0), ' function definitions found.') END AS message
FROM (SELECT x.tree_id, coalesce(p.total_files, 0) AS total_files, coalesce(p.total_loc, 0) AS total_loc
      FROM (SELECT tree_id FROM in_functions UNION SELECT tree_id FROM in_polyglot_lines) x LEFT JOIN ptot p USING (tree_id)) t
LEFT JOIN pdtot d USING (tree_id)
""")
def quality_gates(inp):
    """The trees that should have been produced: the functions' and the polyglot one, of which nothing was."""
    trees = inp.functions().select("tree_id").union(inp.table("in_polyglot_lines").select("tree_id"))
    return P.quality_gates(_produced(inp), trees)


@query("plan_progress", """
SELECT plan_id, count(*) AS tasks_total, count(*) FILTER (WHERE coalesce(passes, false)) AS tasks_passed,
       bool_and(coalesce(passes, false)) AS all_done, bool_or(NOT coalesce(passes, false)) AS any_pending
FROM fx_tasks GROUP BY 1
""")
def plan_progress(inp):
    return P.plan_progress(inp.table("fx_tasks"))


@query("auto_complete_tasks", """
SELECT t.plan_id, t.task_id, t.passes, coalesce(t.passes, false) OR coalesce(f.size, 0) > 100 AS passes_after
FROM fx_tasks t LEFT JOIN fx_files f ON f.path = t.target_file
""")
def auto_complete_tasks(inp):
    return P.auto_complete_tasks(inp.table("fx_tasks"), inp.table("fx_files"))


@query("next_task", """
SELECT plan_id, task_id, priority FROM fx_tasks WHERE NOT coalesce(passes, false)
QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY priority, task_id) = 1
""")
def next_task(inp):
    return P.next_task(inp.table("fx_tasks"))


@query("log_signals", f"""
WITH tl AS (SELECT run_id, bool_or(contains(line, '{C.COMPLETION_MARKER}')) AS done_in_tail
            FROM (SELECT * FROM fx_log QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY seq DESC) <= {C.LOG_TAIL_LINES}) x
            GROUP BY 1),
rl AS (SELECT run_id, count(*) AS n_lines,
              count(*) FILTER (WHERE regexp_matches(line, 'rate.limit|429|too many requests|overloaded', 'i')) AS rate_limit_lines
       FROM fx_log GROUP BY 1)
SELECT rl.*, tl.done_in_tail, rl.rate_limit_lines > 0 AS rate_limited FROM rl JOIN tl USING (run_id)
""")
def log_signals(inp):
    return P.log_signals(inp.table("fx_log"))


def _binaries_for_coverage(inp):
    comp = O.composition(inp.functions(), inp.mapped(), inp.call_graph())
    mode = O.analysis_mode(comp)
    fm = inp.mapped().groupBy("binary_id").agg(F.count(F.lit(1)).alias("function_map_rows"))
    fr = inp.functions().groupBy("binary_id", "tree_id").agg(F.count(F.lit(1)).alias("function_rows"))
    return (fr.join(mode.select("binary_id", "mode", "analysis_target_count"), ["binary_id"], "left")
            .join(fm, ["binary_id"], "left").fillna(0, ["function_map_rows"]))


@query("coverage_metric", f"""
WITH {COMP_CTE}, {PROD_CTE},
bm AS (SELECT binary_id, CASE WHEN count(*) FILTER (WHERE final_category = 'framework') > count(*) * 0.1
                              THEN 'custom_extraction' ELSE 'full_reconstruction' END AS mode,
              count(*) FILTER (WHERE final_category = 'unknown') AS analysis_target_count FROM comp GROUP BY 1),
fr AS (SELECT binary_id, tree_id, count(*) AS function_rows FROM in_functions GROUP BY ALL),
fm AS (SELECT binary_id, count(*) AS function_map_rows FROM in_mapped GROUP BY 1),
b AS (SELECT 'binary' AS scope, CAST(fr.binary_id AS BIGINT) AS scope_id, bm.mode,
             CAST(coalesce(d.definitions, 0) AS BIGINT) AS numerator,
             CAST(CASE WHEN bm.mode = 'custom_extraction' THEN bm.analysis_target_count
                       WHEN coalesce(fm.function_map_rows, 0) > 0 THEN fm.function_map_rows
                       ELSE fr.function_rows END AS BIGINT) AS denominator
      FROM fr LEFT JOIN bm USING (binary_id) LEFT JOIN fm USING (binary_id) LEFT JOIN pdtot d ON d.tree_id = fr.tree_id),
p AS (SELECT 'plan' AS scope, plan_id AS scope_id, 'bundled_app' AS mode,
             count(*) FILTER (WHERE coalesce(passes, false)) AS numerator, count(*) AS denominator
      FROM fx_tasks GROUP BY plan_id),
u AS (SELECT * FROM b UNION ALL SELECT * FROM p)
SELECT *, CASE WHEN denominator > 0 THEN numerator * 100 // denominator ELSE 0 END AS coverage_pct FROM u
""")
def coverage_metric(inp):
    return P.coverage_metric(_binaries_for_coverage(inp), _produced(inp), inp.table("fx_tasks"))


@query("uncovered_functions", f"""
WITH {FULL_MAP_CTE},
psrc AS (SELECT tree_id, rel_path, line_no, text, {EXT.format(c='rel_path')} AS ext FROM in_produced_lines),
pdef AS (SELECT DISTINCT tree_id, name FROM (SELECT *, {DEF_NAME} AS name FROM psrc WHERE ext IN ({DEF_EXTS}) AND NOT {EXCLUDED}) d
         WHERE length(name) > 2 AND name NOT IN ({NOT_NAMES}))
SELECT f.* FROM in_functions f LEFT JOIN mmx m ON m.binary_id = f.binary_id AND m.name = f.name
WHERE NOT EXISTS (SELECT 1 FROM pdef d WHERE d.tree_id = f.tree_id
                  AND d.name = coalesce(m.original_name, regexp_replace(f.name, '^_+', '')))
""")
def uncovered_functions(inp):
    maps = all_mappings(inp)  # before the produced lines are written: both are not needed at once
    return P.uncovered_functions(inp.functions(), _produced(inp), maps)


@query("resolve_callee_names", f"""
WITH {FULL_MAP_CTE}, {COMP_CTE},
al AS ({ALIASES_SQL}),
fm AS (SELECT f.binary_id, f.entry_address AS ghidra_address, m.original_name
       FROM fn f JOIN mmx m ON m.binary_id = f.binary_id AND m.name = f.name
       QUALIFY row_number() OVER (PARTITION BY f.binary_id, f.entry_address ORDER BY m.original_name) = 1)
SELECT DISTINCT ae.binary_id, substr(ae.caller_address, 1, 6) AS prefix,
       coalesce(al.original_name, fm.original_name, fw.name) AS api_name
FROM ae JOIN comp u ON u.binary_id = ae.binary_id AND u.entry_address = ae.caller_address AND u.final_category = 'unknown'
JOIN comp fw ON fw.binary_id = ae.binary_id AND fw.entry_address = ae.callee_address AND fw.final_category = 'framework'
LEFT JOIN al ON al.binary_id = ae.binary_id AND al.ghidra_name = fw.name
LEFT JOIN fm ON fm.binary_id = ae.binary_id AND fm.ghidra_address = ae.callee_address
""")
def resolve_callee_names(inp):
    maps = all_mappings(inp)
    comp = O.composition(inp.functions(), inp.mapped(), inp.call_graph())
    fmap = M.function_map(inp.functions(), maps)
    return O.resolve_callee_names(comp, inp.call_graph(), fmap, M.helper_aliases(maps))


@query("task_order", f"""
WITH {FULL_MAP_CTE}, {COMP_CTE},
fmap AS (SELECT f.binary_id, f.entry_address, m.source_file, m.confidence FROM fn f JOIN mmx m ON m.binary_id = f.binary_id AND m.name = f.name),
tfiles AS (SELECT binary_id, min(CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END) AS tier,
                 source_file AS group_key, count(*) AS n_functions FROM fmap GROUP BY binary_id, source_file),
unm AS (SELECT f.binary_id, 3 AS tier, substr(f.entry_address, 1, 6) AS group_key, count(*) AS n_functions FROM fn f
        WHERE NOT EXISTS (SELECT 1 FROM fmap m WHERE m.binary_id = f.binary_id AND m.entry_address = f.entry_address) GROUP BY ALL),
cl AS (SELECT c.binary_id, 4 AS tier, c.prefix AS group_key, c.function_count AS n_functions
       FROM clusters c LEFT JOIN in_triage t ON t.binary_id = c.binary_id AND t.prefix = c.prefix
       WHERE t.label IS NULL OR t.label = 'custom'),
u AS (SELECT * FROM tfiles UNION ALL SELECT * FROM unm UNION ALL SELECT * FROM cl)
SELECT *, concat(tier, '|', CASE WHEN tier = 4 THEN lpad(CAST(1000000000000 - n_functions AS VARCHAR), 13, '0') ELSE '' END,
                 '|', group_key) AS sort_key FROM u
""")
def task_order(inp):
    comp = O.composition(inp.functions(), inp.mapped(), inp.call_graph())
    clusters = O.triaged_clusters(O.cluster_summary(comp, inp.call_graph()), inp.table("in_triage"))
    maps = all_mappings(inp)
    return P.task_order(M.function_map(inp.functions(), maps), clusters, inp.functions())
