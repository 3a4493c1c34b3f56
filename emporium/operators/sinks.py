"""Sinks: versioned multi-table publish, report outputs, snapshots, statistics.

The reference loads all nine tables in one transaction.  Parquet folders
have no transactions, so every publish writes each table under a fresh
version folder and only then writes a small manifest naming that version;
readers resolve tables through the newest manifest.  A crash before the
manifest leaves the previous version in force, so the publish is
all-or-nothing, and a rerun with the same version id overwrites only its
own folders.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

MANIFEST_DIR = "_manifests"
# Independent outputs are written by concurrent Spark jobs, submitted from
# this many driver threads (the jobs share the cluster's executors).
WRITERS = 4


def _run_all(tasks: dict, writers: int = WRITERS) -> dict:
    """Run ``{name: callable}`` with up to ``writers`` concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor
    if writers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=writers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


class NothingPublished(FileNotFoundError):
    """The folder holds no (such) published version."""


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    """``(value, version, sequence, committed_ns)`` of every published version;
    versions are ordered by the sequence number, never by their names."""
    try:
        docs = spark.read.text(f"{root.rstrip('/')}/{MANIFEST_DIR}").select("value")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NothingPublished(f"no published version under {root}") from None
    info = F.from_json("value", "version string, sequence long, committed_ns long",
                       {"mode": "FAILFAST"})
    return docs.select("value", info.alias("info")) \
        .select("value", "info.version", F.coalesce("info.sequence", F.lit(0)).alias("sequence"),
                F.coalesce("info.committed_ns", F.lit(0)).alias("committed_ns"))


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                   version: str | None = None, check=None) -> str:
    """Write every table under ``root/<name>/v=<version>`` then the manifest.

    ``check`` (optional) receives the written tables, read back from Parquet,
    before the manifest is written; raising there leaves the version
    unpublished, like a failed transaction.
    """
    version = version or time.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    paths = {name: f"{root.rstrip('/')}/{name}/v={version}" for name in tables}
    _run_all({name: (lambda df=df, path=paths[name]: df.write.mode("overwrite").parquet(path))
              for name, df in tables.items()})
    if check is not None:
        check({name: spark.read.parquet(path) for name, path in paths.items()})
    try:
        newest = _manifests(spark, root).agg(F.max("sequence")).first()[0]
    except NothingPublished:
        newest = None
    manifest = json.dumps({"version": version, "tables": paths, "sequence": (newest or 0) + 1,
                           "committed_ns": time.time_ns()}, sort_keys=True)
    # the manifest is one tiny JSON document; written through Spark so it
    # lands on the same (shared) file system as the tables
    (spark.createDataFrame([(manifest,)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{root.rstrip('/')}/{MANIFEST_DIR}/v={version}"))
    return version


def read_published(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    """Tables of the given (default: newest) published version."""
    manifests = _manifests(spark, root)
    if version is not None:
        manifests = manifests.where(F.col("version") == version)
    doc = manifests.orderBy(F.desc("sequence"), F.desc("committed_ns"), F.desc("version")) \
        .select("value").first()
    if doc is None:
        raise NothingPublished(f"no published version {version or ''} under {root}")
    info = json.loads(doc[0])
    return {name: spark.read.parquet(path) for name, path in info["tables"].items()}


def sanitize_for_export(df: DataFrame) -> DataFrame:
    """Time-zone-aware timestamps become naive UTC wall times (TIMESTAMP_NTZ)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp(c, "UTC"),
                                                 "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_report(sheets: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> int:
    """One output per named result ("sheet"); returns the total row count."""
    return sum(write_sheets(sheets, out_dir, fmt).values())


def write_sheets(sheets: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, int]:
    """Write each sheet; return its row count, observed while writing (each
    result is computed once)."""
    from pyspark.sql import Observation

    def write_one(name: str, df: DataFrame) -> int:
        obs = Observation(f"rows_{name}")
        clean = sanitize_for_export(df).observe(obs, F.count(F.lit(1)).alias("n"))
        writer = clean.write.mode("overwrite")
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(fmt).save(path)
        return obs.get["n"]

    return _run_all({name: (lambda n=name, d=df: write_one(n, d)) for name, df in sheets.items()})


def snapshot(spark: SparkSession, name: str, df: DataFrame, replace: bool = False,
             eager: bool = True) -> DataFrame:
    """``CREATE TEMP TABLE [IF NOT EXISTS] name AS SELECT``: a session snapshot.

    The first creation wins unless ``replace`` (DROP IF EXISTS + CREATE).
    The rows are pinned with a checkpoint in the cluster's checkpoint folder,
    so the snapshot neither changes when its sources change nor disappears
    with a lost executor.
    """
    from emporium.session import checkpoint_dir
    if spark.catalog.tableExists(name):
        if not replace:
            return spark.table(name)
        drop_snapshot(spark, name)
    checkpoint_dir(spark)
    pinned = df.checkpoint(eager=eager)
    pinned.createOrReplaceTempView(name)
    return pinned


def drop_snapshot(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        spark.catalog.dropTempView(name)


def analyze_table(spark: SparkSession, table: str, columns: bool = True) -> None:
    """Refresh optimizer statistics of a catalog table (``ANALYZE``)."""
    suffix = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}")


def write_exposition(samples: DataFrame, path: str, help_text: dict | None = None) -> list[str]:
    """Samples → exposition text as an ordered set of files, a task each.

    The lines are range-partitioned by metric, so each metric's HELP and TYPE
    lines stand once, before its samples; the files' names, which are returned,
    are listed in their order in ``path/_order`` (hidden from readers of ``path``).
    """
    from emporium.operators.metrics import to_exposition
    spark = samples.sparkSession
    to_exposition(samples, help_text).write.mode("overwrite").text(path)
    written = spark.read.text(path).select("_metadata.file_name").distinct().collect()
    names = sorted((r.file_name for r in written), key=lambda n: int(n.split("-")[1]))
    (spark.createDataFrame([(n,) for n in names], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path.rstrip('/')}/_order"))
    return names
