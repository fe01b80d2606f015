"""Composition of a binary: categories, propagation, address clusters (A1-A5, A7, J8, J9,
P8, P12, K2, K3, J12, J16, J18, S2-S4).

Every operator is keyed by ``binary_id``; all aggregates are partial (map-side) so a
binary holding a third of all functions is still spread over every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N
from binlens.session import cut_lineage

K = "binary_id"


def module_chunks(functions: DataFrame, prefix_len: int = C.CLUSTER_PREFIX_LEN) -> DataFrame:
    """A1: per address prefix — count, named count, total bytes, lexical min/max address."""
    return (functions
            .withColumn("prefix", N.addr_cluster_key("entry_address", prefix_len))
            .groupBy(K, "prefix")
            .agg(F.count(F.lit(1)).alias("function_count"),
                 F.sum(F.when(~N.is_auto_name("name"), 1).otherwise(0)).cast("bigint").alias("named_count"),
                 F.sum(F.col("size").cast("bigint")).alias("total_bytes"),
                 F.min("entry_address").alias("min_address"),
                 F.max("entry_address").alias("max_address")))


def by_address(functions: DataFrame, order_col: str | None = None) -> DataFrame:
    """Function table keyed by address; with duplicate addresses the last row wins (Q18).

    The order is that of ``order_col``, or of ``row_no`` if the reader carried it; a table
    without either keeps the row with the greatest name, a declared deterministic choice.
    """
    cols = [c for c in functions.columns if c not in (K, "entry_address")]
    order = F.col(order_col or ("row_no" if "row_no" in functions.columns else "name"))
    return (functions.groupBy(K, "entry_address")
            .agg(F.max_by(F.struct(*cols), order).alias("r"))
            .select(K, "entry_address", "r.*"))


def address_edges(call_graph: DataFrame) -> DataFrame:
    """S3: distinct (caller_address, callee_address); falls back to columns caller/callee;
    edges with an empty end are dropped."""
    cols = set(call_graph.columns)

    def pick(primary: str, fallback: str):
        if primary in cols:
            return F.col(primary)
        if fallback in cols:
            return F.col(fallback)
        return F.lit("")

    caller = pick("caller_address", "caller")
    callee = pick("callee_address", "callee")
    return (call_graph.select(K, caller.alias("caller_address"), callee.alias("callee_address"))
            .where((F.coalesce(F.length("caller_address"), F.lit(0)) > 0)
                   & (F.coalesce(F.length("callee_address"), F.lit(0)) > 0))
            .distinct())


def name_edges(call_graph: DataFrame) -> DataFrame:
    """Distinct (caller_name, callee_name)."""
    return call_graph.select(K, "caller_name", "callee_name").distinct()


def mapped_addresses(function_map: DataFrame) -> DataFrame:
    """The set of mapped addresses."""
    return function_map.select(K, "ghidra_address").distinct()


def framework_membership(functions: DataFrame, mapped: DataFrame) -> DataFrame:
    """Flag each function whose address is mapped to framework source."""
    flags = mapped_addresses(mapped).select(K, F.col("ghidra_address").alias("entry_address"),
                                            F.lit(True).alias("_fw"))
    return (functions.join(flags, [K, "entry_address"], "left")
            .withColumn("is_framework", F.coalesce("_fw", F.lit(False))).drop("_fw"))


def function_category(functions: DataFrame, mapped: DataFrame) -> DataFrame:
    """P8 after J8: category in {framework, compiler_system, unknown} and subcategory."""
    df = framework_membership(by_address(functions), mapped)
    name = F.col("name")
    sub = None
    for subcat, prefixes in C.CATEGORY_RULES:
        cond = F.lit(False)
        for p in prefixes:
            cond = cond | name.startswith(p)
        sub = F.when(cond, subcat) if sub is None else sub.when(cond, subcat)
    libc = (~name.startswith("FUN_")) & name.startswith("_") & (F.length(name) < C.LIBC_STYLE_MAX_LEN)
    sub = sub.when(libc, "libc_style")
    subcategory = F.when(F.col("is_framework"), F.lit(None).cast("string")).otherwise(sub)
    category = (F.when(F.col("is_framework"), "framework")
                .when(subcategory.isNotNull(), "compiler_system")
                .otherwise("unknown"))
    return df.withColumn("subcategory", subcategory).withColumn("category", category)


def only_called_by_framework(categorized: DataFrame, call_graph: DataFrame) -> DataFrame:
    """Unknown functions with at least one caller, every caller a framework function.

    One hop only.  Callers missing from the function table count as non-framework (Q25).
    """
    fw = (categorized.where(F.col("category") == "framework")
          .select(K, F.col("entry_address").alias("caller_address"), F.lit(True).alias("caller_fw")))
    unknown = categorized.where(F.col("category") == "unknown").select(K, "entry_address")
    edges = (address_edges(call_graph)
             .join(unknown.withColumnRenamed("entry_address", "callee_address"), [K, "callee_address"], "left_semi")
             .join(fw, [K, "caller_address"], "left"))
    return (edges.groupBy(K, F.col("callee_address").alias("entry_address"))
            .agg(F.bool_and(F.coalesce("caller_fw", F.lit(False))).alias("all_fw"))
            .where("all_fw").drop("all_fw"))


def composition(functions: DataFrame, mapped: DataFrame, call_graph: DataFrame) -> DataFrame:
    """Final category per function: framework, framework_propagated, compiler_system, unknown."""
    cat = function_category(functions, mapped)
    prop = only_called_by_framework(cat, call_graph).withColumn("_prop", F.lit(True))
    return (cat.join(prop, [K, "entry_address"], "left")
            .withColumn("final_category",
                        F.when(F.col("_prop"), "framework_propagated").otherwise(F.col("category")))
            .drop("_prop"))


def composition_summary(comp: DataFrame) -> DataFrame:
    """A2: count and percentage (1 decimal) per category; pct is null for an empty binary (Q16)."""
    cats = ["framework", "framework_propagated", "compiler_system", "unknown"]
    counts = comp.groupBy(K).agg(
        F.count(F.lit(1)).alias("total_functions"),
        *[F.sum(F.when(F.col("final_category") == c, 1).otherwise(0)).cast("bigint").alias(c) for c in cats])
    stacked = counts.select(K, "total_functions", F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(c).alias("function_count")) for c in cats])).alias("s"))
    return (stacked.select(K, "s.category", "s.function_count", "total_functions")
            .withColumn("pct", F.when(F.col("total_functions") > 0,
                                      F.round(F.col("function_count") * 100.0 / F.col("total_functions"), 1))))


def analysis_mode(comp: DataFrame) -> DataFrame:
    """P12 + report totals: custom_extraction iff framework > 10 % of all functions."""
    agg = comp.groupBy(K).agg(
        F.count(F.lit(1)).alias("total_functions"),
        F.sum(F.when(F.col("final_category") == "framework", 1).otherwise(0)).cast("bigint").alias("framework_count"),
        F.sum(F.when(F.col("final_category") == "unknown", 1).otherwise(0)).cast("bigint").alias("analysis_target_count"),
        F.count_distinct(F.when(F.col("final_category") == "unknown",
                                N.addr_cluster_key("entry_address"))).alias("cluster_count"))
    return agg.withColumn("mode", F.when(F.col("framework_count") > F.col("total_functions") * C.FRAMEWORK_MODE_SHARE,
                                         "custom_extraction").otherwise("full_reconstruction"))


def subcategory_counts(comp: DataFrame) -> DataFrame:
    """A3: number of compiler/system functions per subcategory."""
    return (comp.where(F.col("category") == "compiler_system")
            .groupBy(K, "subcategory").agg(F.count(F.lit(1)).alias("function_count")))


def framework_api_calls(comp: DataFrame, call_graph: DataFrame) -> DataFrame:
    """A5: per remaining unknown function, distinct callees that are framework functions."""
    unknown = comp.where(F.col("final_category") == "unknown").select(K, F.col("entry_address").alias("caller_address"))
    fw = comp.where(F.col("final_category") == "framework").select(K, F.col("entry_address").alias("callee_address"))
    return (address_edges(call_graph)
            .join(unknown, [K, "caller_address"], "left_semi")
            .join(fw, [K, "callee_address"], "left_semi")
            .groupBy(K, "caller_address").agg(F.count(F.lit(1)).alias("framework_api_calls")))


def cluster_summary(comp: DataFrame, call_graph: DataFrame) -> DataFrame:
    """A4: remaining unknown functions per address prefix, with size and framework calls.

    The per-function call counts (A5) are aggregated first and joined one-to-one, so the
    size sum is never multiplied by an edge fan-out.
    """
    calls = framework_api_calls(comp, call_graph).withColumnRenamed("caller_address", "entry_address")
    unknown = comp.where(F.col("final_category") == "unknown")
    return (unknown.join(calls, [K, "entry_address"], "left")
            .withColumn("prefix", N.addr_cluster_key("entry_address"))
            .groupBy(K, "prefix")
            .agg(F.count(F.lit(1)).alias("function_count"),
                 F.sum(F.coalesce(F.col("size").cast("bigint"), F.lit(0))).alias("total_bytes"),
                 F.sum(F.coalesce("framework_api_calls", F.lit(0))).cast("bigint").alias("framework_api_calls"),
                 F.min("entry_address").alias("first_address")))


def top_clusters(clusters: DataFrame, k: int = C.TOP_CLUSTERS) -> DataFrame:
    """K2: the k largest clusters per binary; ties by first appearance (lowest address).

    ``row_number() <= k`` lets Spark insert a per-partition group limit before the
    shuffle, so only k rows per binary and task travel.
    """
    w = Window.partitionBy(K).orderBy(F.desc("function_count"), F.asc("first_address"))
    return (clusters.withColumn("cluster_rank", F.row_number().over(w))
            .where(F.col("cluster_rank") <= k))


def adjacency(call_graph: DataFrame) -> DataFrame:
    """Callers and callees of every function by name, as distinct flat rows.

    A hub function's caller set is not collected into one value; it stays a set of rows
    with its size alongside.
    """
    e = name_edges(call_graph)
    both = (e.select(K, F.col("caller_name").alias("name"), F.lit("callee").alias("direction"),
                     F.col("callee_name").alias("neighbor"))
            .unionByName(e.select(K, F.col("callee_name").alias("name"), F.lit("caller").alias("direction"),
                                  F.col("caller_name").alias("neighbor"))))
    deg = both.groupBy(K, "name", "direction").agg(F.count(F.lit(1)).alias("degree"))
    return both.join(deg, [K, "name", "direction"])


def pending_functions(functions: DataFrame, corpus_files: DataFrame) -> DataFrame:
    """Functions whose corpus file (P5 name) is not present yet."""
    return (functions.withColumn("file_name", N.corpus_file_name("name", "entry_address"))
            .join(corpus_files.select(K, "file_name"), [K, "file_name"], "left_anti"))


def latest_labels(triage: DataFrame) -> DataFrame:
    """The label that holds for each prefix: that of the latest cycle, within a cycle the last one given.

    Columns ``cycle`` and ``pos`` may be missing; labels that no column puts in order count by name."""
    order = F.struct(*[F.coalesce(F.col(c).cast("long"), F.lit(-1)) for c in ("cycle", "pos") if c in triage.columns],
                     F.when(F.col("label") == "custom", 1).otherwise(0).alias("custom"), F.col("label"))
    return triage.where(F.col("label").isNotNull()).groupBy(K, "prefix").agg(F.max_by("label", order).alias("label"))


def triaged_clusters(clusters: DataFrame, triage: DataFrame) -> DataFrame:
    """Keep clusters labelled custom or not labelled yet; drop third_party and
    runtime_generated.  Labels carry across cycles: a prefix has the label of the latest cycle
    that names it."""
    return (clusters.join(latest_labels(triage), [K, "prefix"], "left")
            .where(F.col("label").isNull() | (F.col("label") == "custom")))


def resolve_callee_names(comp: DataFrame, call_graph: DataFrame, function_map: DataFrame,
                         aliases: DataFrame) -> DataFrame:
    """Framework APIs called from each remaining unknown cluster, by their best name:
    the helper alias, else the mapped original name, else the raw name.  Distinct rows.  The composition is written,
    since it is read for both ends of a call."""
    comp = cut_lineage(comp.where(F.col("final_category").isin("unknown", "framework")).select(K, "entry_address", "name", "final_category"))
    unknown = (comp.where(F.col("final_category") == "unknown")
               .select(K, F.col("entry_address").alias("caller_address"),
                       N.addr_cluster_key("entry_address").alias("prefix")))
    fw = comp.where(F.col("final_category") == "framework").select(
        K, F.col("entry_address").alias("callee_address"), F.col("name").alias("callee_name"))
    orig = (function_map.groupBy(K, F.col("ghidra_address").alias("callee_address"))
            .agg(F.min("original_name").alias("mapped_name")))
    al = aliases.select(K, F.col("ghidra_name").alias("callee_name"), F.col("original_name").alias("alias_name"))
    # a framework function gets its name once, not once a call: calls move addresses only
    named = (fw.join(al, [K, "callee_name"], "left").join(orig, [K, "callee_address"], "left")
             .select(K, "callee_address", F.coalesce("alias_name", "mapped_name", "callee_name").alias("api_name")))
    return (address_edges(call_graph)
            .join(unknown, [K, "caller_address"]).select(K, "prefix", "callee_address").distinct()
            .join(named, [K, "callee_address"]).select(K, "prefix", "api_name").distinct())
