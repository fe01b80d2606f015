"""Progress of a reconstruction: produced-source totals, gates, coverage, plan tasks and
run logs (A10-A13, J14, K5, K6, X17, X18, J17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N
from binlens.operators import text as X

T = "tree_id"


def source_totals(produced: DataFrame) -> DataFrame:
    """Files and lines over the produced-source extensions."""
    df = X.with_ext(produced).where(F.col("ext").isin(C.PRODUCED_EXTENSIONS))
    return df.groupBy(T).agg(F.count_distinct("rel_path").alias("total_files"),
                             F.count(F.lit(1)).alias("total_loc"))


def definition_total(produced: DataFrame) -> DataFrame:
    """X17 summed over language families."""
    return (X.definition_line_counts(produced).groupBy(T)
            .agg(F.sum("definitions").cast("bigint").alias("definitions")))


def quality_gates(produced: DataFrame, trees: DataFrame | None = None) -> DataFrame:
    """Gate A (files exist), B (>= 500 LOC), C (>= 10 definitions); first failure.

    ``trees`` lists the trees to judge (tree_id); one without any produced source fails gate A.
    Without it, the trees that occur in ``produced`` are judged."""
    trees = (produced if trees is None else trees).select(T).distinct()
    df = (trees.join(source_totals(produced), [T], "left").join(definition_total(produced), [T], "left")
          .withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("total_files", "total_loc")}))
    defs = F.coalesce("definitions", F.lit(0).cast("bigint"))
    gate = (F.when(F.col("total_files") == 0, "A")
            .when(F.col("total_loc") < C.GATE_MIN_LOC, "B")
            .when(defs < C.GATE_MIN_DEFINITIONS, "C"))
    msg = (F.when(F.col("total_files") == 0, F.lit(C.GATE_A_MESSAGE))
           .when(F.col("total_loc") < C.GATE_MIN_LOC,
                 F.format_string(C.GATE_B_MESSAGE, F.col("total_loc"), F.col("total_files")))
           .when(defs < C.GATE_MIN_DEFINITIONS,
                 F.format_string(C.GATE_C_MESSAGE, defs)))
    return df.select(T, "total_files", "total_loc", defs.alias("definitions"), gate.alias("failed_gate"),
                     gate.isNull().alias("passed"), msg.alias("message"))


def plan_progress(tasks: DataFrame) -> DataFrame:
    """Tasks total / passed, all done, any pending per plan."""
    p = F.coalesce("passes", F.lit(False))
    return tasks.groupBy("plan_id").agg(F.count(F.lit(1)).alias("tasks_total"),
                                        F.count_if(p).alias("tasks_passed"),
                                        F.bool_and(p).alias("all_done"),
                                        F.bool_or(~p).alias("any_pending"))


def auto_complete_tasks(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """An unpassed task whose target file exists with more than 100 bytes passes.  Of several rows of a
    path the largest counts; a task stays one row."""
    f = files.groupBy(F.col("path").alias("target_file")).agg(F.max("size").alias("size"))
    return (tasks.join(f, ["target_file"], "left")
            .select("plan_id", "task_id", "passes",
                    (F.coalesce("passes", F.lit(False)) | (F.coalesce("size", F.lit(0)) > 100)).alias("passes_after")))


def next_task(tasks: DataFrame) -> DataFrame:
    """K5: the unpassed task with the smallest priority number per plan; ties by task id.
    A partial aggregate (min_by), so a very large plan is reduced map-side."""
    open_ = tasks.where(~F.coalesce("passes", F.lit(False)))
    return (open_.groupBy("plan_id")
            .agg(F.min_by(F.struct("task_id", "priority"), F.struct("priority", "task_id")).alias("t"))
            .select("plan_id", "t.task_id", "t.priority"))


def log_signals(log: DataFrame) -> DataFrame:
    """Rate-limit lines and the completion marker within the last 30 lines of a run."""
    w = Window.partitionBy("run_id").orderBy(F.desc("seq"))
    tail = (log.withColumn("r", F.row_number().over(w)).where(F.col("r") <= C.LOG_TAIL_LINES)
            .groupBy("run_id").agg(F.max(F.col("line").contains(C.COMPLETION_MARKER)).alias("done_in_tail")))
    rl = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.count_if(F.col("line").rlike(C.RATE_LIMIT_PATTERN)).alias("rate_limit_lines"))
    return (rl.join(tail, ["run_id"])
            .withColumn("rate_limited", F.col("rate_limit_lines") > 0))


def coverage_metric(binaries: DataFrame, produced: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """A10: integer-floor coverage percent, 0 when the denominator is 0.

    ``binaries``: (binary_id, tree_id, mode, analysis_target_count, function_map_rows,
    function_rows).  Denominator by mode: analysis targets (custom_extraction), else
    function-map rows when there is a map, else function rows; numerator: definitions in
    the binary's produced tree.  Plans (bundled_app): passed tasks over all tasks.
    """
    defs = definition_total(produced)
    den = (F.when(F.col("mode") == "custom_extraction", F.col("analysis_target_count"))
           .when(F.col("function_map_rows") > 0, F.col("function_map_rows"))
           .otherwise(F.col("function_rows")))
    b = (binaries.join(defs, [T], "left")
         .select(F.lit("binary").alias("scope"), F.col("binary_id").cast("bigint").alias("scope_id"), "mode",
                 F.coalesce("definitions", F.lit(0)).cast("bigint").alias("numerator"),
                 den.cast("bigint").alias("denominator")))
    if tasks is not None:
        p = plan_progress(tasks).select(F.lit("plan").alias("scope"), F.col("plan_id").cast("bigint").alias("scope_id"),
                                        F.lit("bundled_app").alias("mode"), F.col("tasks_passed").alias("numerator"),
                                        F.col("tasks_total").alias("denominator"))
        b = b.unionByName(p)
    return b.withColumn("coverage_pct", F.when(F.col("denominator") > 0,
                                               F.expr("numerator * 100 div denominator")).otherwise(F.lit(0).cast("bigint")))


def uncovered_functions(functions: DataFrame, produced: DataFrame, mappings: DataFrame) -> DataFrame:
    """Functions with no definition in the produced source.  A function is looked up by the
    name it is mapped to (aliases are mappings, too), else by its own without leading underscores."""
    defs = X.source_definitions(produced).select(T, F.col("name").alias("wanted")).distinct()
    named = functions.join(mappings.select("binary_id", "name", "original_name"), ["binary_id", "name"], "left")
    return (named.withColumn("wanted", F.coalesce("original_name", N.clean_name("name")))
            .join(defs, [T, "wanted"], "left_anti").select(*functions.columns))


def task_order(function_map: DataFrame, clusters: DataFrame, functions: DataFrame) -> DataFrame:
    """K6: work groups in the order tasks are planned: source files whose best mapping is
    high, then medium, then low confidence; then the functions without a mapping, by address
    prefix; then custom clusters, largest first.  Rows come in that order per binary (a
    range-partitioned sort on ``sort_key``)."""
    rank = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    files = (function_map.groupBy("binary_id", "source_file")
             .agg(F.min(rank).alias("tier"), F.count(F.lit(1)).alias("n_functions"))
             .select("binary_id", "tier", F.col("source_file").alias("group_key"), "n_functions"))
    mapped = function_map.select("binary_id", F.col("ghidra_address").alias("entry_address"))
    unmapped = (functions.join(mapped, ["binary_id", "entry_address"], "left_anti")
                .groupBy("binary_id", N.addr_cluster_key("entry_address").alias("group_key"))
                .agg(F.count(F.lit(1)).alias("n_functions"))
                .select("binary_id", F.lit(3).alias("tier"), "group_key", "n_functions"))
    cl = clusters.select("binary_id", F.lit(4).alias("tier"), F.col("prefix").alias("group_key"),
                         F.col("function_count").alias("n_functions"))
    out = files.unionByName(unmapped).unionByName(cl)
    return out.withColumn("sort_key", F.format_string(
        "%d|%s|%s", F.col("tier"),
        F.when(F.col("tier") == 4, F.lpad((F.lit(10 ** 12) - F.col("n_functions")).cast("string"), 13, "0"))
        .otherwise(F.lit("")), F.col("group_key"))).orderBy("binary_id", "sort_key")
