"""Column profile behind the reference's workbook styling.

Per column: the display width (longest rendered value including the
header, plus 2, capped at 40) and, for numeric columns with at least two
values, min / median / max (the three stops of the colour scale).

Widths, counts, minima, maxima and a quantile sketch of all columns come from
ONE aggregate pass.  Medians are exact and interpolated (mean of the two
middle values for an even count, like pandas and spreadsheet percentiles).
Spark's exact ``percentile`` keeps every distinct value of a group in one
task's memory, which does not survive a 100 TB column; :func:`exact_ranks`
takes split points on both sides of a wanted rank from the sketch
(``percentile_approx`` is mergeable and its rank error bounded), and a second
pass over the input counts the values below them and groups the few between
them.  Those are written down sorted by range; counts per partition lead to
the one partition that holds the rank.  Two scans of the input, whatever its
values; a value repeated a billion times is one row of the second.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

MAX_WIDTH = 40


def rendered_length(df: DataFrame, name: str):
    """Length of a value as the workbook renders it (ISO form for dates)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        frac = F.when(F.date_format(c, "SSSSSS") != "000000", F.lit(7)).otherwise(F.lit(0))
        return F.length(base) + frac
    if isinstance(dtype, DateType):
        return F.length(F.date_format(c, "yyyy-MM-dd"))
    return F.length(c.cast("string"))


#: Rank error of the sketch, as a part of the number of values: 1 / ACCURACY.
ACCURACY = 10_000


def _fractions(accuracy: int) -> list[float]:
    """Where the sketch is asked for split points around the median."""
    return [max(0.0, 0.5 - 2 / accuracy), min(1.0, 0.5 + 2 / accuracy)]


def _sketch(x, fractions: list[float], accuracy: int):
    """Split points of a column; NaN, the greatest value, counts as infinity here."""
    return F.percentile_approx(F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x), fractions, accuracy)


@dataclass
class _Stats:
    """A column's first pass: values, least, greatest, split points by fraction."""

    n: int
    lo: float | None
    hi: float | None
    splits: list[tuple[float, float]]

    def bracket(self, ranks: list[int], accuracy: int) -> tuple[float, float]:
        """Split points that hold the 0-based ranks between them, whatever the sketch's error."""
        slack = 1 / accuracy
        below = [v for f, v in self.splits if (f + slack) * self.n <= min(ranks)]
        above = [v for f, v in self.splits if (f - slack) * self.n >= max(ranks) + 1]
        return max(below, default=float("-inf")), min(above, default=float("inf"))


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
                                         for i, c in enumerate(names)])).alias("p")) \
        .select("p.c", "p.v").where(F.col("v").isNotNull())


def exact_ranks(df: DataFrame, names: list[str], stats: dict[str, _Stats], ranks: dict[str, list[int]],
                accuracy: int = ACCURACY) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks of several columns, in one pass over ``df``."""
    from emporium.session import materialise
    names = [c for c in names if ranks.get(c)]
    if not names:
        return {}
    brackets = [stats[c].bracket(ranks[c], accuracy) for c in names]
    at = F.col("c") + 1
    lo = F.element_at(F.array(*[F.lit(b[0]) for b in brackets]), at)
    hi = F.element_at(F.array(*[F.lit(b[1]) for b in brackets]), at)
    v = F.col("v")
    # an upper bound of infinity holds NaN too; null stands for all values below
    counted = _long(df, names).where((v <= hi) | (hi == float("inf"))) \
        .groupBy("c", F.when(v >= lo, v).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    rows = materialise(counted.repartitionByRange("c", "v").sortWithinPartitions("c", "v")
                       .withColumn("part", F.spark_partition_id()), "profile-ranks")
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("c", "part").agg(F.sum("n").alias("size")) \
        .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))  # a row per partition
    wanted = df.sparkSession.createDataFrame(
        [(i, k) for i, c in enumerate(names) for k in sorted(set(ranks[c]))], "c int, k long")
    holding = parts.join(wanted, "c").where("start <= k AND k < start + size")
    upto = Window.partitionBy("c", "k").orderBy("v")
    found = rows.join(holding, ["c", "part"]) \
        .withColumn("end", F.col("start") + F.sum("n").over(upto)) \
        .where("end > k AND end - n <= k").select("c", "k", "v").collect()  # a row per rank
    return {(names[r["c"]], r["k"]): r["v"] for r in found}


def _stats_columns(name: str, i: int, fractions: list[float], accuracy: int) -> list:
    x = F.col(name).cast("double")
    return [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
            _sketch(x, fractions, accuracy).alias(f"q{i}")]


def _stats_of(row, i: int, fractions: list[float]) -> _Stats:
    splits = row[f"q{i}"] or []
    return _Stats(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], list(zip(fractions, splits)))


def exact_kth(values: DataFrame, k: int, accuracy: int = ACCURACY) -> float:
    """The k-th smallest (0-based) of a one-column DataFrame ``v`` (no NULLs)."""
    fractions = [i / 64 for i in range(65)]
    stats = _stats_of(values.agg(*_stats_columns("v", 0, fractions, accuracy)).first(), 0, fractions)
    if not 0 <= k < stats.n:
        raise ValueError(f"rank {k} out of range for {stats.n} values")
    return exact_ranks(values, ["v"], {"v": stats}, {"v": [k]}, accuracy)["v", k]


def exact_median(df: DataFrame, name: str, **kw) -> float | None:
    return exact_medians(df, [name], **kw).get(name)


def exact_medians(df: DataFrame, names: list[str], stats: dict[str, _Stats] | None = None,
                  accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Exact interpolated medians of several numeric columns together; None without values."""
    if stats is None:
        fractions = _fractions(accuracy)
        row = df.agg(*[x for i, c in enumerate(names) for x in _stats_columns(c, i, fractions, accuracy)]).first()
        stats = {c: _stats_of(row, i, fractions) for i, c in enumerate(names)}
    middle = {c: [(stats[c].n - 1) // 2, stats[c].n // 2] for c in names if stats[c].n}
    found = exact_ranks(df, names, stats, middle, accuracy)
    out: dict[str, float | None] = {}
    for c in names:
        if c not in middle:
            out[c] = None
            continue
        low, high = (found[c, k] for k in middle[c])
        out[c] = low if low == high else low + (high - low) * 0.5
    return out


def column_profile(df: DataFrame, method: str = "select") -> DataFrame:
    """One row per column: column, position, width, n_numeric, min, p50, max.

    ``method``: ``'select'`` exact median in a second pass (default),
    ``'approx'`` ``percentile_approx`` (one pass, bounded memory, ±1/10000
    rank error), ``'exact'`` Spark's ``percentile`` (exact, one pass, keeps
    the distinct values of the column in memory).
    """
    spark = df.sparkSession
    cols = df.columns
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
    aggs = [F.max(rendered_length(df, c)).alias(f"w{i}") for i, c in enumerate(cols)]
    for i, c in enumerate(cols):
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += _stats_columns(c, i, _fractions(ACCURACY), ACCURACY)
            if method == "approx":
                aggs.append(F.percentile_approx(x, 0.5, 10000).cast("double").alias(f"p{i}"))
            elif method == "exact":
                aggs.append(F.percentile(x, F.lit(0.5)).alias(f"p{i}"))
    row = df.agg(*aggs).first()
    idx = {c: i for i, c in enumerate(cols)}
    scaled = [c for c in numeric if (row[f"n{idx[c]}"] or 0) >= 2]
    if method == "select":
        stats = {c: _stats_of(row, idx[c], _fractions(ACCURACY)) for c in scaled}
        medians = exact_medians(df, scaled, stats) if scaled else {}
    else:
        medians = {c: row[f"p{idx[c]}"] for c in scaled}
    out = []
    for i, c in enumerate(cols):
        width = min(max(len(c), row[f"w{i}"] or 0) + 2, MAX_WIDTH)
        n = row[f"n{i}"] if c in numeric else 0
        if c in scaled:
            out.append((c, i + 1, width, n, row[f"lo{i}"], medians[c], row[f"hi{i}"]))
        else:
            out.append((c, i + 1, width, n, None, None, None))
    schema = ("column string, position int, width int, n_numeric long, "
              "min double, p50 double, max double")
    return spark.createDataFrame(out, schema)
