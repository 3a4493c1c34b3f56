"""Structured Streaming counterparts of the reference's continuous writers.

The reference inserts orders, items and payments in a loop and polls
metrics every 20 seconds.  Here new rows arrive as files and are processed
by streaming queries:

* ``ingest_if_absent`` — each micro-batch is inserted with
  ``insert_if_absent`` into a Parquet table folder; the batch is written to
  its own ``batch_id=<run>-<n>`` partitions with overwrite (a run is one
  checkpoint; its id is kept beside it), so a replayed batch
  (after a driver or executor failure) replaces its own output instead of
  duplicating it, and it is checked against every *other* batch, so the
  replay does not mistake its first attempt for existing rows.  Stored keys
  are read only from the key-hash buckets the batch touches;
* ``ingest_tables`` — several streams into several tables, a micro-batch in
  one commit, repeated keys ignored over the whole history by a stored index
  (``streaming/epochs.py``);
* ``count_days`` — orders per day from per-batch partial counts, complete
  after every batch, in whatever order the rows arrive;
* ``upsert_latest`` — last value per series, in update mode: a batch writes the
  series it changes;
* ``dedupe_within_watermark`` and ``daily_counts`` — the event-time forms with
  bounded state: keys and days older than the watermark are forgotten, and
  rows that come later are dropped.

Event-time columns must be TIMESTAMP (the test tables store
TIMESTAMP_NTZ, which ``withWatermark`` rejects), so they are cast first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from emporium.operators.metrics import label_key
from emporium.operators.upsert import first_wins, _any_null, _keys
from emporium.streaming.epochs import EpochStore, Table

BATCH_COL = "batch_id"
BUCKET_COL = "key_bucket"
KEY_BUCKETS = 64


def key_bucket(keys: Sequence[str], buckets: int = KEY_BUCKETS) -> Column:
    """Hash bucket of the key (the table's first partition level)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_ingested(spark: SparkSession, table_dir: str) -> DataFrame:
    """The table written by ``ingest_if_absent`` without its layout columns."""
    return spark.read.parquet(table_dir).drop(BUCKET_COL, BATCH_COL)


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Event-time column as TIMESTAMP (session time zone UTC)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def ingest_if_absent(stream: DataFrame, table_dir: str, checkpoint: str, key: str | Sequence[str],
                     order_by: Sequence[Column | str] | None = None,
                     seed: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Continuously ``INSERT ... ON CONFLICT (key) DO NOTHING`` into ``table_dir``.

    The table is partitioned by ``key_bucket`` (a hash of the key) and then
    ``batch_id``.  A micro-batch reads stored keys only from the buckets its
    own keys fall into (partition pruning), so its cost follows the batch,
    not the table.  ``seed`` (optional) is the table's initial content,
    inserted if absent before the stream starts; a restart writes the same
    rows again.  Streams with other checkpoints may write to the same table,
    one after another.  Read the table with :func:`read_ingested`.
    """
    spark = stream.sparkSession
    keys = _keys(key)
    cols = stream.columns
    run = _run_id(spark, checkpoint)

    def write(df: DataFrame, part: str) -> None:
        # whole rows decide the task, so neither a bucket nor null keys bound the writers
        (df.withColumn(BUCKET_COL, key_bucket(keys)).withColumn(BATCH_COL, F.lit(part))
         .repartition(F.col(BUCKET_COL), F.xxhash64(*cols))
         .write.mode("overwrite").partitionBy(BUCKET_COL, BATCH_COL)
         .option("partitionOverwriteMode", "dynamic").parquet(table_dir))

    def absent(df: DataFrame, part: str, touched: list[int] | None = None) -> DataFrame:
        """The rows whose keys are stored by no other batch of any run."""
        try:
            stored = spark.read.parquet(table_dir)
        except AnalysisException as e:  # an empty table: nothing stored yet
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return df
        if touched is not None:
            stored = stored.where(F.col(BUCKET_COL).isin(touched))
        stored = stored.where(F.col(BATCH_COL) != part).select(*keys)
        return df.join(stored, keys, "left_anti")

    if seed is not None:
        write(absent(seed.select(*cols), f"{run}-seed"), f"{run}-seed")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is read twice (bucket ids, rows); keep it for the
        # duration of this batch (spills to disk; recomputed from the source
        # files if an executor is lost)
        batch = batch.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # at most KEY_BUCKETS ids: the buckets this batch can conflict in
            # (de-duplication does not change the set of keys)
            touched = [r[0] for r in batch.where(~_any_null(keys))
                       .select(key_bucket(keys)).distinct().collect()]
            part = f"{run}-{batch_id}"
            write(absent(first_wins(batch, keys, order_by), part, touched), part)
        finally:
            batch.unpersist()

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that owns ``checkpoint``: written beside the
    checkpoint's own files once, so it lives and goes with them."""
    path = f"{checkpoint.rstrip('/')}/run_id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    run = "r" + uuid.uuid4().hex[:16]
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.text(path)
    return run


def _epochs_of(stream: DataFrame, checkpoint: str, write, trigger: dict | None,
               mode: str = "append") -> StreamingQuery:
    """Run ``write(run, batch_id, batch)`` for every micro-batch; what reads a
    batch more than once stages it."""
    run = _run_id(stream.sparkSession, checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write(run, batch_id, batch)

    return (stream.writeStream.outputMode(mode).foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def ingest_tables(streams: dict[str, DataFrame], store: EpochStore, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Continuously insert several streams into the tables of the same names,
    each micro-batch into all of them in one commit.

    Rows whose key is stored, or repeated in the batch, are ignored (see
    :class:`EpochStore`).  The streams advance together in one query, whose
    rows say which table they are for.
    """
    union = None
    for name, stream in streams.items():
        tagged = stream.select(F.lit(name).alias("_table"), F.struct(*stream.columns).alias(name))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)

    def write(run: str, n: int, batch: DataFrame) -> None:
        with store.staged(f"{run}-{n}", "batch", batch) as rows:
            store.commit(run, n, {name: rows.where(F.col("_table") == name).select(f"{name}.*") for name in streams},
                         staged=True)

    return _epochs_of(union, checkpoint, write, trigger)


def count_days(stream: DataFrame, ts: str, store: EpochStore, name: str, checkpoint: str,
               by: Sequence[str] = (), trigger: dict | None = None) -> StreamingQuery:
    """Rows per day: each micro-batch commits its own partial counts, which
    :func:`day_counts` adds up on reading, so a row counts whenever it arrives."""
    def write(run: str, n: int, batch: DataFrame) -> None:
        counts = batch.groupBy(F.to_date(ts).alias("day"), *by).agg(F.count(F.lit(1)).alias("n"))
        store.commit(run, n, {name: counts})

    return _epochs_of(stream, checkpoint, write, trigger)


def day_counts(schema: StructType | str, by: Sequence[str] = ()) -> Table:
    """The table that :func:`count_days` writes to: ``(day, by…, n)``."""
    return Table(_schema(schema), merge=lambda rows: rows.groupBy("day", *by).agg(F.sum("n").alias("n")))


def upsert_latest(stream: DataFrame, store: EpochStore, name: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep the last value per series of a stream of samples (update mode).

    Streaming state holds the last value per series; a micro-batch emits the
    series it met and commits those that changed against the stored values.
    Read the table (see :func:`latest_values`) for the latest of all.
    """
    def write(run: str, n: int, batch: DataFrame) -> None:
        if not store.committed():
            store.commit(run, n, {name: batch})
            return
        stored = store.read(name).select("metric", label_key(F.col("labels")).alias("_lk"),
                                         F.struct("ts", "value").alias("_old"))
        rows = batch.withColumn("_lk", label_key(F.col("labels")))
        changed = rows.join(stored, ["metric", "_lk"], "left") \
            .where(F.col("_old").isNull() | (F.struct("ts", "value") > F.col("_old")))
        store.commit(run, n, {name: changed.select(*batch.columns)})

    return _epochs_of(latest_gauges_stream(stream), checkpoint, write, trigger, "update")


def latest_values(schema: StructType | str) -> Table:
    """The table that :func:`upsert_latest` writes to: the latest row per series."""
    return Table(_schema(schema), merge=latest_gauges_stream)


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def dedupe_within_watermark(stream: DataFrame, key: str | Sequence[str], ts: str,
                            delay: str = "1 day") -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of event time (bounded
    state; :func:`ingest_tables` drops them whenever they arrive)."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    return s.dropDuplicatesWithinWatermark(_keys(key))


def daily_counts(stream: DataFrame, ts: str, delay: str = "1 day",
                 by: Sequence[str] = ()) -> DataFrame:
    """Rows per event-time day (tumbling window), final once the watermark
    passes; later rows are dropped (:func:`count_days` drops none)."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    return (s.groupBy(F.window(ts, "1 day").alias("day"), *by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.to_date(F.col("day.start")).alias("day"), *by, "n"))


def latest_gauges_stream(samples: DataFrame) -> DataFrame:
    """Last successful value per (metric, labels), kept in streaming state."""
    s = samples.where(F.col("ok")) if "ok" in samples.columns else samples
    latest = F.max_by(F.struct("ts", "value", "labels"), F.struct("ts", "value"))
    return (s.groupBy("metric", label_key(F.col("labels")).alias("_lk"))
            .agg(latest.alias("_l"))
            .select("metric", F.col("_l.labels").alias("labels"), F.col("_l.ts").alias("ts"),
                    F.col("_l.value").alias("value")))


def run_to_table(df: DataFrame, out_dir: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a streaming aggregate until the available input is consumed,
    writing each micro-batch's output to Parquet (``availableNow``)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(BATCH_COL, F.lit(batch_id)).write.mode("overwrite")
         .partitionBy(BATCH_COL).option("partitionOverwriteMode", "dynamic").parquet(out_dir))
    return (df.writeStream.outputMode(mode).foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def scratch_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders under the cluster's checkpoint folder."""
    from emporium.session import scratch_path
    run = scratch_path(spark, name)
    return f"{run}/out", f"{run}/checkpoint"
