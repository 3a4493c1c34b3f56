"""Reproducible stand-ins for ``random()``.

The reference picks rows with ``ORDER BY random() LIMIT k`` and jitters
values with ``random()``.  A job that can be retried after an executor loss
must not change its answer on the retry, so the "random" choice is a seeded
hash of the row key: same seed, same rows, on any cluster layout.  MD5 is
used because it is a built-in function with one definition in every SQL
engine, so an independent SQL check can reproduce the pick.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(key: Column, seed: int | str) -> Column:
    """Hex digest that orders rows pseudo-randomly for a given seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def seeded_uniform(key: Column, seed: int | str) -> Column:
    """Deterministic uniform value in [0, 1) derived from the key and seed."""
    digest = seeded_key(key, seed)
    bits = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return bits.cast("double") / F.lit(4294967296.0)
