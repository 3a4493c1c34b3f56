"""String helpers: padded ids, empty-string defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, n: Column, width: int = 5) -> Column:
    """``prefix`` + zero-padded number, e.g. ``load_cust_00042``."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", n.cast("long")))


def or_default(value: Column, default: Column) -> Column:
    """Python's ``value or default`` for strings: NULL and '' take the default."""
    return F.coalesce(F.nullif(value, F.lit("")), default)
