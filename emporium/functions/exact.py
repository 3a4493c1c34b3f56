"""Exact numeric helpers.

Money is summed as DECIMAL and only turned into DOUBLE at the very end, so
the result does not depend on the order in which partitions are combined.
Rounded ratios (shares, averages shown with 2 or 3 digits) are computed with
integer division, which gives ROUND_HALF_UP on the exact rational value,
instead of rounding a double that may sit one ulp below the half.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    """A money column as DECIMAL(10,2)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(10,2)")


def cents(c: Column) -> Column:
    """Exact whole number of cents of a DECIMAL money expression."""
    return (c * F.lit(100)).cast("decimal(38,0)")


def exact_mean(total: Column, n: Column) -> Column:
    """Mean as DOUBLE from an exact sum and a count (NULL when n = 0)."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def int_div(a: Column, b: Column) -> Column:
    """floor(a / b) for whole numbers a >= 0, b > 0, computed exactly."""
    a = a.cast("decimal(38,0)")
    b = b.cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("long")


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """ROUND_HALF_UP(num / den, digits) as DOUBLE for whole num and den.

    ``num`` and ``den`` must be whole numbers (integer or DECIMAL(p,0)).
    Negative numerators round half away from zero, like NUMERIC. NULL when
    den is 0 or NULL.
    """
    scale = 10 ** digits
    num = num.cast("decimal(38,0)")
    den = den.cast("decimal(38,0)")
    units = int_div(F.abs(num) * F.lit(2 * scale) + den, den * F.lit(2))
    signed = F.when(num < 0, -units).otherwise(units)
    return F.when(den > 0, signed.cast("double") / F.lit(float(scale)))


def percent(n: Column, total: Column, digits: int = 2) -> Column:
    """ROUND(100.0 * n / total, digits) as DOUBLE, exact half-up."""
    return round_ratio(n * F.lit(100), total, digits)


def round_money_mean(total: Column, n: Column, digits: int = 2) -> Column:
    """ROUND(AVG(money), digits) from an exact DECIMAL(.,2) sum and a count."""
    return round_ratio(cents(total), n * F.lit(100), digits)
