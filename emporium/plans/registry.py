"""Registry of runnable queries: name → (spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporium.plans.reports import REPORTS
from emporium.session import apply_conf
from emporium.sources.testdata import Star

Query = Callable[[SparkSession, str], DataFrame]


def _bind(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(Star(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def registered() -> dict[str, Query]:
    out: dict[str, Query] = {name: _bind(fn) for name, fn in REPORTS.items()}
    from emporium.plans import jobs  # table jobs: DML, quality, metrics, points
    from emporium.plans.sql import SQL_REPORTS  # the same reports as SQL text
    out.update({name: _bind(fn) for name, fn in SQL_REPORTS.items()})
    out.update({name: _bind(fn) for name, fn in jobs.JOBS.items()})
    return out
