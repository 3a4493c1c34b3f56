"""Dense series: zero-filled key × month grids and cumulative frames.

The reference builds these in pandas (reindex on a product index, then a
loop of concatenated frames).  Here the aggregated series is read once per
key: each key's values are gathered into a month → value map (its size is
bounded by the number of months, not by the data), and the grid is
generated with ``sequence`` + ``explode`` between the global first and last
month.  Those bounds are a window over the per-key rows when the caller
bounds the key count (a top-k), else one scalar subquery returning a struct.
There is no cross join, no join back to the series and no loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_month():
    return F.expr("INTERVAL 1 MONTH")


def month_bounds(series: DataFrame, month: str) -> Column:
    """struct(lo, hi): first and last month of ``series`` (one scalar subquery)."""
    return series.agg(F.struct(F.min(month).alias("lo"), F.max(month).alias("hi"))).scalar()


def _key_maps(series: DataFrame, key: str, month: str, value: str,
              few_keys: bool) -> DataFrame:
    """One row per key: its month → value map and the global month bounds.

    With ``few_keys`` (a key count bounded by the caller, e.g. a top-k) the
    bounds come from a window over the per-key rows, so the series is read
    once; otherwise from one scalar subquery over the series.
    """
    per_key = (series.groupBy(key)
               .agg(F.map_from_entries(F.collect_list(F.struct(month, value))).alias("_m"),
                    F.min(month).alias("_klo"), F.max(month).alias("_khi")))
    if few_keys:
        every = Window.partitionBy()   # all keys in one partition: bounded by the caller
        return per_key.select(key, "_m", F.min("_klo").over(every).alias("_lo"),
                              F.max("_khi").over(every).alias("_hi"))
    b = month_bounds(series, month)
    return per_key.select(key, "_m", b["lo"].alias("_lo"), b["hi"].alias("_hi"))


def densify_months(series: DataFrame, key: str, month: str, value: str, fill=0,
                   few_keys: bool = False) -> DataFrame:
    """Every (key, month) from the global first to last month; gaps get ``fill``.

    ``series`` has one row per (key, month) with month a DATE at the first
    of the month.  Output size is |keys| × |months|.
    """
    value_type = dict(series.dtypes)[value]
    pk = _key_maps(series, key, month, value, few_keys)
    grid = pk.select(key, "_m", F.explode(F.sequence("_lo", "_hi", _one_month())).alias(month))
    return grid.select(key, month, F.coalesce(F.col("_m")[F.col(month)],
                                              F.lit(fill).cast(value_type)).alias(value))


def densify_with_frames(series: DataFrame, key: str, month: str, value: str,
                        frame: str = "frame", fill=0, few_keys: bool = False) -> DataFrame:
    """``cumulative_frames(densify_months(...))`` generated in one pass: each
    dense (key, month) row is repeated for every frame month from its own
    month to the last month."""
    value_type = dict(series.dtypes)[value]
    pk = _key_maps(series, key, month, value, few_keys)
    grid = pk.select(key, "_m", "_hi",
                     F.explode(F.sequence("_lo", "_hi", _one_month())).alias(month))
    return grid.select(F.explode(F.sequence(F.col(month), F.col("_hi"), _one_month())).alias(frame),
                       key, month, F.coalesce(F.col("_m")[F.col(month)],
                                              F.lit(fill).cast(value_type)).alias(value))


def cumulative_frames(df: DataFrame, month: str, frame: str = "frame",
                      last: Column | None = None) -> DataFrame:
    """For each frame month f (every month present), the rows with month <= f.

    Equivalent to the non-equi join ``rows ⋈ frames ON month <= frame``;
    each row is repeated for the frames at or after its month.  ``last`` is
    the last frame month (default: max month of ``df``).
    """
    hi = df.agg(F.max(month)).scalar() if last is None else last
    return df.select(F.explode(F.sequence(F.col(month), hi, _one_month())).alias(frame), "*")
