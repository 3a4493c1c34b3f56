"""Joins on keys of which a few may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one row in this many; there are fewer
#: hot keys than this.
MOST_HOT_KEYS = 1_000


def join_counted(rows: DataFrame, table: DataFrame, key: list[str], total: int,
                 n: str = "n") -> DataFrame:
    """``rows`` ⋈ ``table`` on ``key``, without ``n``.

    ``table`` has one row of fixed size per key and in ``n`` the number of
    ``rows`` with the key, at least; ``total`` is the sum of ``n`` over all keys or
    more.  The hot keys are broadcast, fewer than ``MOST_HOT_KEYS`` rows of
    ``table`` by their definition, and their ``rows`` stay where they are; the
    others join by a shuffle in which no key is large.  Both inputs are read
    more than once: give tables that are written down.
    """
    is_hot = F.col(n) > F.lit(total) / MOST_HOT_KEYS
    hot = F.broadcast(table.where(is_hot).drop(n))
    others = rows.join(F.broadcast(hot.select(*key)), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(table.where(~is_hot).drop(n), key))
