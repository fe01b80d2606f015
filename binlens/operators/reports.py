"""Report records as nested rows (A2, A6, A14): structs, arrays and maps, one row per binary or bundle.

What a record nests is bounded by a catalog (categories, methods, languages) or by its own
top-k; everything that grows with a binary stays in the flat operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import bundle as U
from binlens.operators import compose as O
from binlens.operators import mapping as M

B, D = "binary_id", "bundle_id"


def _counter(df: DataFrame, key: str, value: str, n: str, name: str) -> DataFrame:
    """Rows of (key, value, n) as one map per key, values in order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(value).alias("k"), F.col(n).alias("n"))))
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.map_from_entries(entries).alias(name))


def _pct(count: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(count * 100.0 / total, 1))


def composition_report(comp: DataFrame, call_graph: DataFrame, top: int = C.TOP_CLUSTERS) -> DataFrame:
    """A2 + A3 + K2 + P12: the composition document of every binary."""
    mode = O.analysis_mode(comp)
    counts = comp.groupBy(B).pivot("final_category", list(C.CATEGORY_DESCRIPTIONS)).agg(F.count(F.lit(1))).fillna(0)
    subs = _counter(O.subcategory_counts(comp), B, "subcategory", "function_count", "subcategories")
    order = F.array_sort(F.collect_list(F.struct("cluster_rank", "prefix", "function_count", "total_bytes", "framework_api_calls")))
    tops = (O.top_clusters(O.cluster_summary(comp, call_graph), top).groupBy(B)
            .agg(F.transform(order, lambda c: F.struct(c["prefix"].alias("prefix"), c["function_count"].alias("function_count"),
                                                       c["total_bytes"].alias("total_bytes"),
                                                       c["framework_api_calls"].alias("framework_api_calls"))).alias("top_clusters")))
    df = mode.join(counts, [B]).join(subs, [B], "left").join(tops, [B], "left")

    def category(name: str, *more: Column) -> Column:
        text = C.CATEGORY_DESCRIPTIONS[name]
        return F.struct(F.col(name).alias("count"), _pct(F.col(name), F.col("total_functions")).alias("pct"),
                        *([F.lit(text).alias("description")] if text else []), *more).alias(name)

    return df.select(B, "total_functions", F.struct(
        category("framework"), category("framework_propagated"),
        category("compiler_system", F.col("subcategories")),
        category("unknown", F.col("cluster_count"), F.col("top_clusters"))).alias("categories"),
        "analysis_target_count", "mode")


def mapping_report(functions: DataFrame, mappings: DataFrame) -> DataFrame:
    """Totals with the three counter maps."""
    rows = M.mapping_breakdown(mappings)
    out = M.mapping_stats(functions, mappings)
    for name in ("by_method", "by_confidence", "by_language"):
        out = out.join(_counter(rows.where(F.col("dimension") == name), B, "value", "n", name), [B], "left")
    return out


def chunk_index(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """A14 + X16: per kept chunk its file, lines, size and hint arrays."""
    return chunks.join(U.chunk_hints(lines, chunks), [D, "idx"])
