"""Session settings shared by every job.

The library never builds its own cluster session: it takes the caller's
``SparkSession`` and only sets SQL options that are safe to change at
runtime.  ``local_session`` exists for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL options the pipeline relies on for correct results (ANSI casts, UTC
# wall clock) and for plans that hold at scale (AQE re-planning, skew splitting).
RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark

# Rows of long texts that go to a Python worker at once: workers keep what their largest batch took.
TEXT_BATCH = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """Python workers get ``TEXT_BATCH`` rows at a time, so the workers of all stages fit in an executor together."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    return spark


def _driver_memory() -> str:
    """Heap for a local session: 60% of physical memory, at most 16 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    mb = max(1024, min(16 * 1024, int(total * 0.6 / (1024 * 1024))))
    return f"{mb}m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fundflow", event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FUNDFLOW_DRIVER_MEMORY", _driver_memory()))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder, and read back.

    Cuts lineage like a checkpoint, but in columns, so later reads are pruned; a lost
    executor never costs more than what was not yet written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by the operator in
    ``spark.checkpoint.dir``; a machine-local temporary folder would lose
    checkpoint files together with the executor that wrote them.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    folder = tempfile.mkdtemp(prefix="fundflow-ckpt-")
    sc.setCheckpointDir(folder)
    return folder
