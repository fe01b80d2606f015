"""Building of the inputs and the cost of the definition scan."""

import os

from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import text as X
from binlens.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_statements_for_spark_give_the_rows_of_the_views(spark, monkeypatch):
    got = {v: rows(FX.Inputs(spark, SF)._derive(v)) for v in FX.SPARK_SQL}
    monkeypatch.setattr(FX, "SPARK_SQL", {})
    assert got and all(got[v] and got[v] == rows(FX.Inputs(spark, SF)._derive(v)) for v in got)


def test_shared_views_are_derived_once(spark, tmp_path, monkeypatch):
    derived = []
    plain = FX.Inputs._derive
    monkeypatch.setattr(FX.Inputs, "_derive", lambda self, name: (self.cache_dir and derived.append(name)) or plain(self, name))
    inp, alone = FX.Inputs(spark, SF, cache_dir=str(tmp_path)), FX.Inputs(spark, SF)
    for name in ("in_produced_lines", "in_source_lines", "in_functions", "in_call_graph", "in_decompiled"):
        assert rows(inp.table(name)) == rows(alone.table(name))
    assert all(derived.count(v) == 1 for v in (*FX.SHARED, "in_source_lines", "in_call_graph"))
    assert len([w for w in os.listdir(tmp_path) if "source_lines" in w or "call_graph" in w]) == 2


def test_call_graph_keys_are_distinct_before_names_are_joined(spark):
    """The exchanges of the call table move its two keys; names come after them, and nothing is told apart by names."""
    plan = FX.Inputs(spark, SF)._derive("fx_call_graph")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Project") and "Aggregate [caller_name" not in plan


def test_definition_patterns_are_matched_once_a_line(spark):
    """Filters on the name do not bring the patterns with them into the scan."""
    lines = spark.createDataFrame([(0, "src/a.cpp", 1, "void run_it(int a) {"), (0, "src/b.zig", 1, "pub fn go_on(x: u8) void {"),
                                   (0, "src/b.rs", 1, "pub fn generic<T>(x: T)"), (0, "test/a.cpp", 1, "void not_here(int a) {")],
                                  "tree_id int, rel_path string, line_no int, text string").where(F.col("line_no") > 0)
    found = X.source_definitions(lines)
    assert {r.name for r in found.collect()} == {"run_it", "go_on", "generic"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(C.DEFINITION_PATTERNS[".go"]) == 1 and plan.count(X._TRAILING_BLANKS) <= 2
