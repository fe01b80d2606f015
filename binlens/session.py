"""Spark session and lineage helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session defaults. AQE re-plans joins and coalesces partitions at runtime; the
# skew-join rule splits a hot key (one binary, one file, one literal) across tasks.
# The window-group-limit threshold is raised so that the first-N caps of the
# identification step (up to 100,000 rows per binary) are applied map-side
# before the shuffle instead of after it.  A job's shuffle files go when it ends, not when
# the driver's garbage collector finds them: every job here ends in a written table.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "200000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "binlens", driver_memory: str | None = "12g") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:  # local mode: the driver JVM is the executor
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL defaults on a session somebody else created."""
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.ui."):  # fixed when the session starts
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local master (tests, one machine) gets a scratch folder when none is named; on a cluster
    that would be a folder other machines cannot see, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="binlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store Spark reads it from."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Survives the loss of the executors that computed it; later reads take only the columns they need, and
    the planner knows the size."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(*tables: DataFrame) -> None:
    """Delete the files of tables from ``cut_lineage`` that nothing will read again; other tables are left alone."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("cut-"):
                path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
                path.getFileSystem(conf).delete(path, True)
