"""Row predicates with the reference's (PostgreSQL) semantics spelled out.

Each returns a boolean Column, so Catalyst can push it to the scan when it
is written on stored columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def eq_filter(col: Column | str, value) -> Column:
    """``col = value`` (NULL never matches)."""
    return _c(col) == F.lit(value)


def range_cmp(col: Column | str, op: str, value) -> Column:
    """``col <op> value`` for op in <, <=, >, >=."""
    c, v = _c(col), value if isinstance(value, Column) else F.lit(value)
    return {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[op]


def between_filter(col: Column | str, lo, hi) -> Column:
    """``col BETWEEN lo AND hi`` — both ends inclusive."""
    return _c(col).between(lo, hi)


def in_list(col: Column | str, values: Iterable) -> Column:
    """``col IN (v1, v2, ...)`` with a literal list."""
    return _c(col).isin(list(values))


def not_null(*cols: Column | str) -> Column:
    """``c1 IS NOT NULL AND c2 IS NOT NULL ...``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull()
    return cond


def like_prefix(col: Column | str, prefix: str) -> Column:
    """``col LIKE prefix || '%'``: ``_`` and ``%`` inside ``prefix`` stay
    wildcards, exactly as in the reference (so this is not ``startswith``)."""
    return _c(col).like(prefix + "%")


def ilike_match(col: Column | str, pattern: str, exact: bool = False) -> Column:
    """``col ILIKE pattern``: case-insensitive whole-string match in which
    ``%``/``_`` are wildcards; ``exact=True`` compares lower-cased strings."""
    c = _c(col)
    return (F.lower(c) == F.lower(F.lit(pattern))) if exact else c.ilike(pattern)


def late_flag(actual: Column | str, promised: Column | str) -> Column:
    """``actual > promised`` between two timestamp columns (NULL when either is)."""
    return _c(actual) > _c(promised)
