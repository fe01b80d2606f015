"""Run-log monitoring as a stream (X18 over an append-only log folder).

A run appends its output to log files while it works; each new file is picked up by
Structured Streaming and the per-run counters (lines, rate-limit lines, completion
markers) are kept as streaming aggregate state in the checkpoint folder, so a restarted
query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binlens.functions import catalog as C


def log_lines_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Lines of the run logs in ``log_dir``; the run id is the file name without extension."""
    df = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(log_dir)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)(\.[^./]*)?$", 1)
    return df.select(run.alias("run_id"), F.col("value").alias("line"))


def log_signal_counts(lines: DataFrame) -> DataFrame:
    """Running counters per run: lines, rate-limit lines, completion markers."""
    return lines.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("line").rlike(C.RATE_LIMIT_PATTERN)).alias("rate_limit_lines"),
        F.count_if(F.col("line").contains(C.COMPLETION_MARKER)).alias("completion_markers"))


def start_log_watch(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str):
    """Write the counters of every micro-batch to ``out_dir`` (complete output, rewritten
    per batch through foreachBatch) and return the running query."""

    def sink(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    return (log_signal_counts(log_lines_stream(spark, log_dir)).writeStream
            .outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(sink).trigger(availableNow=True).start())
