"""Session settings the library relies on.

The queries assume a UTC session (month and day buckets depend on it), ANSI
arithmetic (overflow and bad casts raise instead of producing NULL) and AQE
(runtime coalescing of shuffle partitions, broadcast switching and skew-join
splitting).  ``build_session`` is for tests and local runs; on a cluster the
caller owns the session and ``apply_conf`` only fills in what is unset.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query depends on for its results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect the physical plan; kept if the cluster set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition counts as skewed from 5x the median and 256 MB on
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # broadcasts are only chosen from measured sizes, never from guesses
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Force the result-relevant settings, default the plan-relevant ones."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "emporium", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (no UI, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EMPORIUM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of collected DataFrames are removed, not kept forever
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**REQUIRED_CONF, **DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_conf(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job scratch.

    ``spark.checkpoint.dir`` names it on a cluster.  A session without the
    setting (tests, local runs) uses a ``_scratch`` folder in its own
    warehouse, which by definition every executor of the session can reach;
    the caller's configuration is left as it is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder (job outputs, stream state)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/jobs/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under ``scratch_path``.

    Results that read from scratch (job outputs, written stages) cannot be
    used afterwards, so the caller decides when.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(root):
        fs.delete(root, True)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and
    the rows no longer depend on any executor's local disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
