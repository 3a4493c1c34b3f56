"""``row_number() OVER (PARTITION BY key ORDER BY ...)`` without a hot task.

A window sends every row of a key to one task; a key holding a third of the
table would be numbered by a single task.  Here the rows are range-
partitioned on (key, order columns), so a hot key is spread over as many
partitions as its size needs, and each row's number is derived from
positions:

1. after the range shuffle and a sort inside each partition, the global
   order is (partition id, index in partition); ``monotonically_increasing_id``
   encodes exactly that pair.  These positions are checkpointed (written to
   the cluster's checkpoint folder) before they are used twice: the range
   partitioner samples its bounds per plan, so two consumers — or a retry —
   recomputing the shuffle could otherwise see different partitions;
2. per-partition row counts (one row per partition, a bounded table) give
   every partition's start offset, hence a dense global position;
3. a key's first position is a partially aggregated ``min`` per key, and
   the row number is position − first + 1.

Rows that tie on all key and order columns are numbered in an arbitrary
order, as with a window.

The range path costs a range shuffle and a checkpoint, so it is taken only
when a key is actually hot: one partially aggregated job measures the
largest key first, and when it fits in one task (``hot_key_rows``) the
plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Rows of one key that a single task may number with a window.
HOT_KEY_ROWS = 2_000_000


def number_within_key(df: DataFrame, key: Sequence[str], order: Sequence[str],
                      out: str = "row_number", num_partitions: int | None = None,
                      hot_key_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    key, order = list(key), list(order)
    spark = df.sparkSession
    cols = df.columns
    if hot_key_rows is not None:
        biggest = df.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
        if biggest <= hot_key_rows:
            w = Window.partitionBy(*key).orderBy(*order)
            return df.select(*cols, F.row_number().over(w).cast("int").alias(out))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *key, *order).sortWithinPartitions(*key, *order)
    from emporium.session import checkpoint_dir
    checkpoint_dir(spark)
    pos = ranged.select("*", F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    # one row per partition: a bounded table, broadcast by size
    sizes = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    dense = pos.join(F.broadcast(starts), "_pid").withColumn("_pos", F.col("_start") + index)
    first = dense.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]) \
        .agg(F.min("_pos").alias("_first"))
    cond = [dense[k].eqNullSafe(first[f"_k{i}"]) for i, k in enumerate(key)]
    joined = dense.join(first, cond)
    return joined.select(*cols, (F.col("_pos") - F.col("_first") + 1).cast("int").alias(out))
