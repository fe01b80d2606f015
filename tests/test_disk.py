"""What the mapping leaves on disk and what its joins move."""

import os

from pyspark.sql import functions as F

from binlens.operators import compose as O
from binlens.operators import mapping as M
from binlens.operators import text as X
from binlens.plans.registry import load_all
from binlens.session import checkpoint_dir, cut_lineage, let_go
from binlens.sources import fixtures as FX

from test_plans import _exchanged


def dense_tree(spark, n=150, apart=2):
    """``n`` named functions, each ``apart`` lines from the next, each with calls of three others; one leads to FUN_x."""
    text = []
    for i in range(n):
        text += [(0, "m.c", apart * i + 1, f"void d{i:03}(void) {{"), (0, "m.c", apart * i + 2, f"  d{(i + 1) % n:03}(); d{(i + 7) % n:03}(); late{i:03}();")]
    text += [(0, "z.c", 100 * i + 1, f"void late{i:03}(void) {{") for i in range(n)]
    lines = spark.createDataFrame(text, "tree_id int, rel_path string, line_no int, text string")
    functions = spark.createDataFrame([(0, 0, f"d{i:03}", f"{i:04}") for i in range(n)] + [(0, 0, f"FUN_{i:03}", f"9{i:03}") for i in range(n)],
                                      "binary_id int, tree_id int, name string, entry_address string")
    graph = spark.createDataFrame([(0, f"d{i:03}", f"FUN_{i:03}") for i in range(n)], "binary_id int, caller_name string, callee_name string")
    return lines, functions, graph


def written(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("cut-")}


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.startswith("shuffle_") and f.endswith(".data") for d in dirs for _, _, fs in os.walk(d) for f in fs)


def test_jobs_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = cut_lineage(spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count())
    assert rows.count() == 100 and shuffle_files(spark) <= before
    twice = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
    assert sorted(twice.collect()) == sorted(twice.collect()) == sorted(rows.collect())


def test_propagation_keeps_only_its_mappings(spark):
    lines, functions, graph = dense_tree(spark, 20)
    first = X.first_posting(X.source_definitions(lines))
    direct = M.direct_matches(functions, first, None)
    before = written(spark)
    out = M.call_graph_propagate(direct, graph, lines, first)
    left = written(spark) - before
    kept = {f.rsplit("/", 2)[1] for f in out.inputFiles()}
    assert out.count() == 40 and kept <= left
    # beside the mappings: the one round that found nothing
    assert len(left - kept) <= 1


def test_tables_of_others_are_not_let_go(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    mine, cut = spark.read.parquet(str(tmp_path / "mine")), cut_lineage(spark.range(3))
    let_go(mine, cut)
    assert mine.count() == 3 and not {f.rsplit("/", 2)[1] for f in cut.inputFiles()} & written(spark)


def _moved(df):
    """Rows that the shuffles of a finished plan wrote."""
    df.collect()
    total, stack, seen = 0, [df._jdf.queryExecution().executedPlan()], set()
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
            continue
        if node.nodeName() == "Exchange" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_calls_are_looked_up_once_not_once_a_window(spark):
    """Windows of 55 lines hold the calls of 27 functions here; the candidates of all windows are never shuffled."""
    lines, functions, graph = dense_tree(spark)
    first = cut_lineage(X.first_posting(X.source_definitions(lines)))
    mapped = cut_lineage(M.direct_matches(functions, first, None))
    calls = cut_lineage(M.known_calls(lines, first))
    used = mapped.select("binary_id", F.col("original_name").alias("cand_name")).distinct()
    pairs = M.callee_candidates(mapped, calls).count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        offer, _ = M.offers(mapped, lambda near: used, calls, False)
        assert pairs > 10_000 and _moved(offer) < pairs / 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert M.open_calls(lines, first, mapped).select("cand_name").distinct().count() == 150  # the late ones
    got = {r["caller_name"]: r["cand_name"] for r in offer.collect()}
    assert len(got) == 150 and got["d010"] == "late008"  # first in line order from four lines above


def test_open_names_are_those_that_some_binary_has_left(spark):
    first = spark.createDataFrame([(t, n) for t in (0, 1) for n in ("a", "b", "c")], "tree_id int, name string")
    mapped = spark.createDataFrame([(1, 0, "a"), (2, 0, "a"), (2, 0, "b"), (1, 1, "c")], "binary_id int, tree_id int, original_name string")
    # of tree 0 both binaries have used a, binary 2 alone has used b, binary 1 alone c (in tree 1); tree 1 has binary 1 only
    assert sorted(map(tuple, M.open_names(first, mapped).collect())) == [(0, "b"), (0, "c"), (1, "b")]


def test_calls_move_no_names_when_callees_are_resolved(spark, inputs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        carried = _exchanged(load_all()["resolve_callee_names"].plan(inputs))
        assert carried and not any("prefix#" in c and "callee_name#" in c for c in carried), carried
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_produced_lines_are_written_after_the_mapping(spark, tmp_path, monkeypatch):
    asked = []
    for name in ("table", "derived"):
        plain = getattr(FX.Inputs, name)
        monkeypatch.setattr(FX.Inputs, name, lambda self, view, *a, plain=plain: (asked.append(view), plain(self, view, *a))[1])
    load_all()["uncovered_functions"].plan(FX.Inputs(spark, "/root/testdata/sf0.001", cache_dir=str(tmp_path)))
    assert asked.index("all_mappings") < asked.index("in_produced_lines")
