"""Sharding: a two-pass external shuffle, in DataFrame functions only.

Pass one reads the records once, gives each a seeded 64-bit hash and writes
them to the shared folder; the hash scatters them uniformly into buckets of
about ``bucket_bytes``.  Pass two brings each bucket together, numbers its
records in hash order and lets a Fisher-Yates shuffle (Spark's ``shuffle``
of the bucket's positions) decide their order.  The buckets laid end to end
are a random order of all records; shard s is the s-th of ``shards`` equal
stretches of it, so shard counts differ by one at most.

Records move through one spilling shuffle and sort; the only other rows are
one per bucket (its count, its place and its shuffled positions, four bytes a
record), written down before use so that a rerun task sees the same order.

Defined results: a null text has size 16 and checksum 0; an empty table gives
no rows; repeated rows and rows with null ids are records like any other and
scatter apart, since the position of a row in its input file is hashed too.
Columns of the input with the names ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import materialise

SHARDS = 40
SEED = 42
#: Target bytes of a bucket: small against an executor's memory.
BUCKET_BYTES = 16 << 20


def record_size(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def _placed(docs: DataFrame, id_col: str, text_col: str, shards: int, seed: int,
            bucket_bytes: int) -> DataFrame:
    """``(doc struct, shard, slot)`` for every record."""
    records = materialise(
        docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
                    record_size(docs[text_col]).alias("size"),
                    F.xxhash64(F.lit(seed), docs[id_col], docs[text_col],
                               F.monotonically_increasing_id()).alias("key")), "shard-records")
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    records = records.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)))

    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = records.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    plan = materialise(
        counts.select("bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("place"),
                      F.sum("n").over(Window.partitionBy()).alias("rows"))
        .orderBy("bucket")
        .withColumn("order", F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), seed)),
        "shard-plan")

    numbered = records.select("doc", "bucket", (F.row_number().over(
        Window.partitionBy("bucket").orderBy("key")) - 1).alias("at"))
    spot = numbered.join(plan, "bucket").select(
        "doc", "rows", (F.col("place") + F.get("order", F.col("at"))).alias("spot"))
    # the first `rows % shards` shards hold one record more
    share = F.expr(f"rows div {shards}")
    larger = F.col("rows") % shards
    edge = larger * (share + 1)
    # (share is 0 only when there are fewer records than shards: all lie before the edge)
    shard = F.when(F.col("spot") < edge, F.floor(F.col("spot") / (share + 1))) \
        .otherwise(larger + F.floor((F.col("spot") - edge) / F.greatest(share, F.lit(1))))
    start = F.col("shard") * share + F.least(F.col("shard").cast("long"), larger)
    return spot.withColumn("shard", shard.cast("int")) \
        .select("doc", "shard", (F.col("spot") - start).alias("slot"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``shard`` (0 to ``shards`` - 1) and ``slot``
    (gapless from 0 in each shard)."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return _placed(docs, id_col, text_col, shards, seed, bucket_bytes) \
        .select(*(F.col("doc")[c].alias(c) for c in kept), "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards as ``shard=<n>`` folders with their records in slot order."""
    placed = shard(docs, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per record."""
    placed = shard(docs)
    return placed.select(
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
