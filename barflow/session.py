"""Session helpers.

Library functions never build a session: they take DataFrames. These helpers
exist for tests, the bench and the driver entry point, and for the few places
that need a shared directory (streaming checkpoints, lineage cuts).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Where local runs (tests, bench) put their shared folder: one machine, so every task sees it.
LOCAL_SHARED = "/tmp/barflow-shared"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",  # concurrent fits share the slots
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str = "local[8]", app: str = "barflow", checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the bench (cluster jobs pass their own).

    ``checkpoint_dir`` names the shared folder for written tables; a local run
    may leave it out and gets one of its own below ``LOCAL_SHARED``.
    """
    builder = SparkSession.builder.master(master).appName(app)
    merged = dict(DEFAULT_CONF)
    merged.update({k.replace("__", "."): v for k, v in conf.items()})
    if master.startswith("local"):
        checkpoint_dir = checkpoint_dir or f"{LOCAL_SHARED}/{app}-{uuid.uuid4().hex[:12]}"
    if checkpoint_dir:
        merged["spark.checkpoint.dir"] = checkpoint_dir
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from barflow import ensure_importable

    ensure_importable(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; an error if it is not set.

    Every executor must see the folder, so it is never made up here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("spark.checkpoint.dir is not set; name a folder that the driver and all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the tables this process wrote below the shared folder (at the end of a run); returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Used where a derived table (e.g. bars aggregated from ticks) feeds several
    passes: the index's count pass and its main pass, or Spark ML's many
    passes. One computation, lineage cut, and the files survive executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
