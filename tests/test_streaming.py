import os
import tempfile

from binlens.streaming.logwatch import start_log_watch


def test_log_watch_counts(spark):
    d = tempfile.mkdtemp()
    logs = os.path.join(d, "logs")
    os.makedirs(logs)
    with open(os.path.join(logs, "run7.log"), "w") as f:
        f.write("step one\nHTTP 429 Too Many Requests\nmodel overloaded\n<promise>CYCLE_DONE</promise>\n")
    with open(os.path.join(logs, "run8.log"), "w") as f:
        f.write("step\nRate-limit reached\n")
    q = start_log_watch(spark, logs, os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    rows = {r["run_id"]: (r["n_lines"], r["rate_limit_lines"], r["completion_markers"])
            for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    assert rows == {"run7": (4, 2, 1), "run8": (2, 1, 0)}
