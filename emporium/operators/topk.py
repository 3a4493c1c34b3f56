"""Top-k, semi-joins on a computed top-k, and reproducible "random" picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions.picks import seeded_key


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """ORDER BY ... LIMIT k.

    Planned as TakeOrderedAndProject: every partition keeps its own k best
    rows and only those reach the final merge, so no full sort or shuffle
    of the input happens.  ``order`` should end in a unique key; ties under
    LIMIT are otherwise arbitrary, as in the reference.
    """
    return df.orderBy(*order).limit(k)


def isin_top_k(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (a LIMITed frame): left semi join.

    ``keys`` is broadcast when its LIMIT proves it small.
    """
    from emporium.operators.bounds import broadcast_if_bounded
    return df.join(broadcast_if_bounded(keys), on, "left_semi")


isin_topk = isin_top_k   # the operator inventory's name


def is_empty(df: DataFrame) -> bool:
    """Early exit on an empty result: reads at most one row."""
    return df.isEmpty()


def seeded_pick(df: DataFrame, key: str, k: int, seed: int | str) -> DataFrame:
    """``ORDER BY random() LIMIT k`` made reproducible: k rows by seeded hash."""
    h = seeded_key(F.col(key), seed)
    return df.orderBy(h, F.col(key)).limit(k)
