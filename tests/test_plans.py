"""Physical-plan audit of every registered query (built on the sf0.001 inputs)."""

from binlens.operators import mapping as M
from binlens.operators import text as X
from binlens.plans.registry import load_all


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_risky_operators_in_any_plan(inputs):
    risky = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "SinglePartition", "BroadcastNestedLoopJoin")
    bad = [(name, marker) for name, q in load_all().items() for marker in risky if marker in _plan(q.plan(inputs))]
    assert bad == []


def _exchanged(df):
    """What each shuffle or broadcast of the plan carries: the output of the node under it."""
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.initialPlan())
            continue
        if "Exchange" in node.nodeName():
            out.append(node.output().mkString(","))
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return out


def test_no_source_text_is_shuffled(inputs, spark):
    lines = inputs.source_lines()
    first = X.first_posting(X.source_definitions(lines))
    anchors = spark.createDataFrame([], "binary_id int, tree_id int, func_name string, entry_address string, best_file string, best_line long")
    callers = spark.createDataFrame([], "binary_id int, tree_id int, name string, order_key string, source_file string, source_line long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calls = M.known_calls(lines, first)
        for df in (calls, M.callee_candidates(callers, calls), M.enclosing_definition(anchors, lines)):
            carried = _exchanged(df)
            assert carried and not any("text#" in c for c in carried), carried
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
