"""Stage timings of one registered query from Spark's event log (no UI needed).

    python tools/stage_times.py call_graph_propagate [--sf /root/testdata/sf0.1] [--top 15]

Runs the query once on materialised inputs in a fresh scratch folder with the event log
enabled, then prints the job / stage counts and the slowest stages.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(path: str):
    for f in sorted(glob.glob(os.path.join(path, "*", "events_*")) + glob.glob(os.path.join(path, "*.zstd"))):
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("query")
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--top", type=int, default=15)
    args = ap.parse_args()
    scratch = tempfile.mkdtemp(prefix="binlens-stages-")
    os.makedirs(os.path.join(scratch, "ev"), exist_ok=True)  # must exist before the context starts
    from pyspark.sql import SparkSession

    from binlens.plans.registry import load_all
    from binlens.session import apply_defaults
    from binlens.sources.fixtures import Inputs
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", os.path.join(scratch, "ev"))
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    inp = Inputs(spark, args.sf, cache_dir=os.path.join(scratch, "inputs"))
    q = load_all()[args.query]
    q.plan(inp).write.format("noop").mode("overwrite").save()      # materialises inputs, warms up
    t = time.time()
    q.plan(inp).write.format("noop").mode("overwrite").save()
    wall = time.time() - t
    spark.stop()
    stages = []
    for e in read_events(os.path.join(scratch, "ev")):
        if e["Event"] == "SparkListenerStageCompleted" and "Completion Time" in e["Stage Info"]:
            i = e["Stage Info"]
            stages.append((i["Completion Time"] - i["Submission Time"], i["Number of Tasks"], i["Stage Name"][:80]))
    print(f"{args.query}: second run {wall:.2f}s; {len(stages)} stages in the whole log, "
          f"{sum(s[0] for s in stages) / 1000:.1f}s of stage time")
    for ms, tasks, name in sorted(stages, reverse=True)[:args.top]:
        print(f"  {ms:6d} ms  {tasks:4d} tasks  {name}")


if __name__ == "__main__":
    main()
