"""Queries over the function table and call graph: module chunks and composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.functions import names as N
from binlens.operators import compose as O
from binlens.operators import reports as R
from binlens.plans.registry import query

# Shared oracle CTEs: the composition of fixture binary 0, written independently in SQL.
COMP_CTE = """
fa AS (SELECT * FROM in_functions
       QUALIFY row_number() OVER (PARTITION BY binary_id, entry_address ORDER BY name DESC) = 1),
mp AS (SELECT DISTINCT binary_id, ghidra_address FROM in_mapped),
cat AS (
  SELECT fa.*, (mp.ghidra_address IS NOT NULL) AS is_framework,
    CASE WHEN mp.ghidra_address IS NOT NULL THEN NULL
         WHEN starts_with(name, 'thunk_') THEN 'thunks'
         WHEN starts_with(name, '__') THEN 'system'
         WHEN starts_with(name, '_ZN') OR starts_with(name, '_ZL') OR starts_with(name, '_ZTV') THEN 'cpp_mangled'
         WHEN starts_with(name, 'caseD_') OR starts_with(name, 'switchD_') THEN 'switch_cases'
         WHEN NOT starts_with(name, 'FUN_') AND starts_with(name, '_') AND length(name) < 30 THEN 'libc_style'
    END AS subcategory
  FROM fa LEFT JOIN mp ON mp.binary_id = fa.binary_id AND mp.ghidra_address = fa.entry_address),
cat2 AS (SELECT *, CASE WHEN is_framework THEN 'framework' WHEN subcategory IS NOT NULL THEN 'compiler_system'
                        ELSE 'unknown' END AS category FROM cat),
ae AS (SELECT DISTINCT binary_id, caller_address, callee_address FROM in_call_graph
       WHERE length(caller_address) > 0 AND length(callee_address) > 0),
prop AS (SELECT ae.binary_id, ae.callee_address AS entry_address
         FROM ae JOIN cat2 u ON u.binary_id = ae.binary_id AND u.entry_address = ae.callee_address
                            AND u.category = 'unknown'
         LEFT JOIN cat2 c ON c.binary_id = ae.binary_id AND c.entry_address = ae.caller_address
         GROUP BY 1, 2 HAVING bool_and(coalesce(c.category = 'framework', false))),
comp AS (SELECT cat2.*, CASE WHEN prop.entry_address IS NOT NULL THEN 'framework_propagated'
                             ELSE category END AS final_category
         FROM cat2 LEFT JOIN prop USING (binary_id, entry_address)),
fwcalls AS (SELECT ae.binary_id, ae.caller_address, count(*) AS framework_api_calls
            FROM ae JOIN comp u ON u.binary_id = ae.binary_id AND u.entry_address = ae.caller_address
                               AND u.final_category = 'unknown'
                    JOIN comp f ON f.binary_id = ae.binary_id AND f.entry_address = ae.callee_address
                               AND f.final_category = 'framework'
            GROUP BY 1, 2),
clusters AS (SELECT u.binary_id, CASE WHEN length(u.entry_address) > 6 THEN substr(u.entry_address, 1, 6)
                                      ELSE u.entry_address END AS prefix,
                    count(*) AS function_count, CAST(sum(coalesce(u.size, 0)) AS BIGINT) AS total_bytes,
                    CAST(sum(coalesce(c.framework_api_calls, 0)) AS BIGINT) AS framework_api_calls,
                    min(u.entry_address) AS first_address
             FROM comp u LEFT JOIN fwcalls c ON c.binary_id = u.binary_id AND c.caller_address = u.entry_address
             WHERE u.final_category = 'unknown' GROUP BY 1, 2)
"""


def _comp(inp):
    return O.composition(inp.functions(), inp.mapped(), inp.call_graph())


@query("module_chunks", """
SELECT binary_id, CASE WHEN length(entry_address) > 6 THEN substr(entry_address, 1, 6) ELSE entry_address END AS prefix,
       count(*) AS function_count,
       CAST(sum(CASE WHEN starts_with(name, 'FUN_') OR starts_with(name, 'thunk_') THEN 0 ELSE 1 END) AS BIGINT) AS named_count,
       CAST(sum(size) AS BIGINT) AS total_bytes, min(entry_address) AS min_address, max(entry_address) AS max_address
FROM in_functions GROUP BY 1, 2
""")
def module_chunks(inp):
    return O.module_chunks(inp.functions())


@query("function_category", f"""
WITH {COMP_CTE}
SELECT binary_id, entry_address, name, category, subcategory FROM cat2
""")
def function_category(inp):
    return (O.function_category(inp.functions(), inp.mapped())
            .select("binary_id", "entry_address", "name", "category", "subcategory"))


@query("framework_membership", """
SELECT f.binary_id, f.entry_address, f.name, m.ghidra_address IS NOT NULL AS is_framework
FROM in_functions f LEFT JOIN (SELECT DISTINCT binary_id, ghidra_address FROM in_mapped) m
  ON m.binary_id = f.binary_id AND m.ghidra_address = f.entry_address
""")
def framework_membership(inp):
    return (O.framework_membership(inp.functions(), inp.mapped())
            .select("binary_id", "entry_address", "name", "is_framework"))


@query("only_called_by_framework", f"""
WITH {COMP_CTE}
SELECT prop.binary_id, prop.entry_address, cat2.name FROM prop JOIN cat2 USING (binary_id, entry_address)
""")
def only_called_by_framework(inp):
    cat = O.function_category(inp.functions(), inp.mapped())
    return (O.only_called_by_framework(cat, inp.call_graph())
            .join(cat.select("binary_id", "entry_address", "name"), ["binary_id", "entry_address"]))


@query("composition_summary", f"""
WITH {COMP_CTE},
cats AS (SELECT * FROM (VALUES ('framework'), ('framework_propagated'), ('compiler_system'), ('unknown')) t(category)),
tot AS (SELECT binary_id, count(*) AS total_functions FROM comp GROUP BY 1)
SELECT tot.binary_id, cats.category,
       CAST((SELECT count(*) FROM comp c WHERE c.binary_id = tot.binary_id AND c.final_category = cats.category) AS BIGINT) AS function_count,
       tot.total_functions,
       round((SELECT count(*) FROM comp c WHERE c.binary_id = tot.binary_id AND c.final_category = cats.category) * 100.0
             / tot.total_functions, 1) AS pct
FROM tot CROSS JOIN cats
""")
def composition_summary(inp):
    return O.composition_summary(_comp(inp))


@query("analysis_mode", f"""
WITH {COMP_CTE}
SELECT binary_id, count(*) AS total_functions,
       CAST(count(*) FILTER (WHERE final_category = 'framework') AS BIGINT) AS framework_count,
       CAST(count(*) FILTER (WHERE final_category = 'unknown') AS BIGINT) AS analysis_target_count,
       count(DISTINCT CASE WHEN final_category = 'unknown' THEN substr(entry_address, 1, 6) END) AS cluster_count,
       CASE WHEN count(*) FILTER (WHERE final_category = 'framework') > count(*) * 0.1
            THEN 'custom_extraction' ELSE 'full_reconstruction' END AS mode
FROM comp GROUP BY 1
""")
def analysis_mode(inp):
    return O.analysis_mode(_comp(inp))


@query("subcategory_counts", f"""
WITH {COMP_CTE}
SELECT binary_id, subcategory, count(*) AS function_count FROM comp WHERE category = 'compiler_system' GROUP BY 1, 2
""")
def subcategory_counts(inp):
    return O.subcategory_counts(_comp(inp))


@query("framework_api_calls", f"""
WITH {COMP_CTE}
SELECT binary_id, caller_address, framework_api_calls FROM fwcalls
""")
def framework_api_calls(inp):
    return O.framework_api_calls(_comp(inp), inp.call_graph())


@query("cluster_summary", f"""
WITH {COMP_CTE}
SELECT * FROM clusters
""")
def cluster_summary(inp):
    return O.cluster_summary(_comp(inp), inp.call_graph())


@query("cluster_summary_top30", f"""
WITH {COMP_CTE}
SELECT *, CAST(row_number() OVER (PARTITION BY binary_id ORDER BY function_count DESC, first_address) AS INTEGER) AS cluster_rank
FROM clusters QUALIFY cluster_rank <= 30
""")
def cluster_summary_top30(inp):
    return O.top_clusters(O.cluster_summary(_comp(inp), inp.call_graph()))


@query("composition_report", f"""
WITH {COMP_CTE},
n AS (SELECT binary_id, count(*) AS total_functions, count(*) FILTER (WHERE final_category = 'framework') AS fw,
             count(*) FILTER (WHERE final_category = 'framework_propagated') AS fwp,
             count(*) FILTER (WHERE final_category = 'compiler_system') AS cs,
             count(*) FILTER (WHERE final_category = 'unknown') AS un FROM comp GROUP BY 1),
sc AS (SELECT binary_id, string_agg(concat(subcategory, '=', n), ',' ORDER BY subcategory) AS subcategories
       FROM (SELECT binary_id, subcategory, count(*) AS n FROM comp WHERE category = 'compiler_system' GROUP BY ALL) x GROUP BY 1),
tc AS (SELECT binary_id, count(*) AS cluster_count FROM clusters GROUP BY 1),
tp AS (SELECT binary_id, string_agg(concat(prefix, ':', function_count, ':', total_bytes, ':', framework_api_calls), ',' ORDER BY r) AS tops
       FROM (SELECT *, row_number() OVER (PARTITION BY binary_id ORDER BY function_count DESC, first_address) AS r
             FROM clusters QUALIFY r <= 30) x GROUP BY 1)
SELECT n.binary_id, n.total_functions, n.fw AS framework, n.fwp AS framework_propagated, n.cs AS compiler_system, n.un AS unknown,
       round(n.fw * 100.0 / n.total_functions, 1) AS framework_pct, sc.subcategories, tc.cluster_count, tp.tops AS top_clusters,
       n.un AS analysis_target_count,
       CASE WHEN n.fw > n.total_functions * 0.1 THEN 'custom_extraction' ELSE 'full_reconstruction' END AS mode
FROM n LEFT JOIN sc USING (binary_id) LEFT JOIN tc USING (binary_id) LEFT JOIN tp USING (binary_id)
""")
def composition_report(inp):
    """The nested document, flattened here for the comparison only."""
    c = R.composition_report(_comp(inp), inp.call_graph())
    cat = F.col("categories")
    pairs = F.transform(F.map_entries(cat["compiler_system"]["subcategories"]), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    tops = F.transform(cat["unknown"]["top_clusters"], lambda t: F.concat_ws(
        ":", t["prefix"], t["function_count"].cast("string"), t["total_bytes"].cast("string"), t["framework_api_calls"].cast("string")))
    return c.select("binary_id", "total_functions", *[cat[x]["count"].alias(x) for x in (
        "framework", "framework_propagated", "compiler_system", "unknown")], cat["framework"]["pct"].alias("framework_pct"),
        F.array_join(pairs, ",").alias("subcategories"), cat["unknown"]["cluster_count"].alias("cluster_count"),
        F.array_join(tops, ",").alias("top_clusters"), "analysis_target_count", "mode")


@query("call_edges_by_name", """
SELECT DISTINCT binary_id, caller_name, callee_name FROM in_call_graph
""")
def call_edges_by_name(inp):
    return O.name_edges(inp.call_graph())


@query("call_edges_by_address", """
SELECT DISTINCT binary_id, caller_address, callee_address FROM in_call_graph
WHERE length(caller_address) > 0 AND length(callee_address) > 0
""")
def call_edges_by_address(inp):
    return O.address_edges(inp.call_graph())


@query("mapped_addresses", """
SELECT DISTINCT binary_id, ghidra_address FROM in_mapped
""")
def mapped_addresses(inp):
    return O.mapped_addresses(inp.mapped())


@query("adjacency_sets", """
WITH e AS (SELECT DISTINCT binary_id, caller_name, callee_name FROM in_call_graph),
b AS (SELECT binary_id, caller_name AS name, 'callee' AS direction, callee_name AS neighbor FROM e
      UNION ALL SELECT binary_id, callee_name, 'caller', caller_name FROM e)
SELECT *, count(*) OVER (PARTITION BY binary_id, name, direction) AS degree FROM b
""")
def adjacency_sets(inp):
    return O.adjacency(inp.call_graph())


@query("pending_functions", """
SELECT f.*, concat(regexp_replace(f.name, '[^a-zA-Z0-9_]', '_', 'g'), '_', f.entry_address, '.c') AS file_name
FROM in_functions f
WHERE NOT EXISTS (SELECT 1 FROM in_corpus_files c WHERE c.binary_id = f.binary_id
                  AND c.file_name = concat(regexp_replace(f.name, '[^a-zA-Z0-9_]', '_', 'g'), '_', f.entry_address, '.c'))
""")
def pending_functions(inp):
    return O.pending_functions(inp.functions(), inp.table("in_corpus_files"))


@query("triaged_clusters", f"""
WITH {COMP_CTE}
SELECT c.*, t.label FROM clusters c LEFT JOIN in_triage t ON t.binary_id = c.binary_id AND t.prefix = c.prefix
WHERE t.label IS NULL OR t.label = 'custom'
""")
def triaged_clusters(inp):
    clusters = O.cluster_summary(_comp(inp), inp.call_graph())
    return O.triaged_clusters(clusters, inp.table("in_triage"))


@query("triaged_clusters_over_cycles", f"""
WITH {COMP_CTE},
labels AS (SELECT binary_id, prefix, label, 1 AS cycle FROM in_triage
  UNION ALL SELECT binary_id, prefix, CASE WHEN label = 'custom' THEN 'third_party' ELSE 'custom' END, 3 FROM in_triage WHERE length(prefix) > 0 AND right(prefix, 1) < '8'
  UNION ALL SELECT binary_id, prefix, 'custom', 2 FROM in_triage),
latest AS (SELECT binary_id, prefix, arg_max(label, cycle) AS label FROM labels GROUP BY binary_id, prefix)
SELECT c.*, t.label FROM clusters c LEFT JOIN latest t ON t.binary_id = c.binary_id AND t.prefix = c.prefix
WHERE t.label IS NULL OR t.label = 'custom'
""")
def triaged_clusters_over_cycles(inp):
    """J18 with three cycles of labels, of which the second names every prefix and the third some."""
    first = inp.table("in_triage").select("binary_id", "prefix", "label")
    again = first.where(F.expr("right(prefix, 1) < '8'")).withColumn("label", F.when(F.col("label") == "custom", "third_party").otherwise("custom"))
    labels = (first.withColumn("cycle", F.lit(1)).unionByName(again.withColumn("cycle", F.lit(3)))
              .unionByName(first.withColumns({"label": F.lit("custom"), "cycle": F.lit(2)})))
    return O.triaged_clusters(O.cluster_summary(_comp(inp), inp.call_graph()), labels)


@query("function_index", """
SELECT binary_id, name, entry_address AS address, size, param_count AS params, return_type FROM in_functions
""")
def function_index(inp):
    """The 5-column function index, every function included."""
    f = inp.functions()
    return f.select("binary_id", "name", F.col("entry_address").alias("address"), "size",
                    F.col("param_count").alias("params"), "return_type")


@query("scan_functions", """
SELECT binary_id, tree_id, name, entry_address, end_address, size, param_count, return_type, calling_convention,
       is_thunk, is_external FROM in_functions
""")
def scan_functions(inp):
    """The function table with its fixed schema."""
    return inp.functions()


@query("function_name_keys", """
SELECT binary_id, entry_address, name,
       starts_with(name, 'FUN_') OR starts_with(name, 'thunk_') AS is_auto_name,
       regexp_replace(name, '^_+', '') AS clean_name,
       CASE WHEN length(entry_address) > 6 THEN substr(entry_address, 1, 6) ELSE entry_address END AS cluster_key,
       CASE WHEN length(entry_address) > 3 THEN substr(entry_address, 1, length(entry_address) - 3) ELSE 'misc' END AS dir_key,
       concat(regexp_replace(name, '[^a-zA-Z0-9_]', '_', 'g'), '_', entry_address, '.c') AS corpus_file
FROM in_functions
""")
def function_name_keys(inp):
    """P1-P5 on every function: auto name, clean name, cluster and folder keys, file name."""
    f = inp.functions()
    return f.select("binary_id", "entry_address", "name", N.is_auto_name("name").alias("is_auto_name"),
                    N.clean_name("name").alias("clean_name"), N.addr_cluster_key("entry_address").alias("cluster_key"),
                    N.addr_dir_key("entry_address").alias("dir_key"),
                    N.corpus_file_name("name", "entry_address").alias("corpus_file"))


@query("demangled_tails", """
SELECT binary_id, name, demangled_name, trim(split_part(string_split(demangled_name, '::')[-1], '(', 1)) AS tail
FROM in_demangled
""")
def demangled_tails(inp):
    """P9 on the demangled names."""
    d = inp.table("in_demangled")
    return d.select("binary_id", "name", "demangled_name", N.symbol_tail("demangled_name").alias("tail"))


@query("sorted_modules", """
SELECT binary_id, CASE WHEN length(entry_address) > 6 THEN substr(entry_address, 1, 6) ELSE entry_address END AS prefix,
       count(*) AS function_count,
       CAST(sum(CASE WHEN starts_with(name, 'FUN_') OR starts_with(name, 'thunk_') THEN 0 ELSE 1 END) AS BIGINT) AS named_count,
       CAST(sum(size) AS BIGINT) AS total_bytes, min(entry_address) AS min_address, max(entry_address) AS max_address
FROM in_functions GROUP BY 1, 2 ORDER BY 1, 2
""")
def sorted_modules(inp):
    """K3: module chunks in prefix order (a range-partitioned sort, not one task)."""
    return O.module_chunks(inp.functions()).orderBy("binary_id", "prefix")
