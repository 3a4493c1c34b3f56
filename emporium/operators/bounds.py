"""Broadcast only what has a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count broadcast on the strength of a proven bound alone.
MAX_BROADCAST_ROWS = 1_000_000


def max_rows(df: DataFrame) -> int | None:
    """Upper bound on the row count that Catalyst can prove (LIMIT, one-row
    aggregates, literal ranges), or None when the size depends on the data."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def broadcast_if_bounded(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is provably at most ``limit``;
    otherwise ``df`` unchanged, so the planner decides from measured sizes."""
    n = max_rows(df)
    return F.broadcast(df) if n is not None and n <= limit else df
