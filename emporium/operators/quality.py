"""Data quality: key checks, request-style validation, catalog counts.

Spark does not enforce primary, unique or foreign keys, so the reference's
constraints become report operators that return the offending rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators.upsert import _any_null, _keys


def check_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (PK / unique index).

    NULL-containing keys are not reported: a unique index allows them.
    The count is a partially aggregated group-by, so a hot key collapses
    map-side before the shuffle.
    """
    keys = _keys(key)
    return (df.where(~_any_null(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def check_foreign_key(child: DataFrame, fk: str | Sequence[str], parent: DataFrame,
                      key: str | Sequence[str]) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row."""
    fk_cols, keys = _keys(fk), _keys(key)
    parents = parent.select(*[F.col(k).alias(f) for k, f in zip(keys, fk_cols)])
    return child.where(~_any_null(fk_cols)).join(parents, fk_cols, "left_anti")


# Fixed values of the reference's request models (defaults and limits).
CUSTOMER_DEFAULTS = {"customer_zip_code_prefix": 0, "customer_city": "unknown",
                     "customer_state": "NA"}
SELLER_DEFAULTS = {"seller_zip_code_prefix": 0, "seller_city": "unknown",
                   "seller_state": "NA"}
ORDER_DEFAULTS = {"order_status": "created"}
STATE_MIN_LEN, STATE_MAX_LEN = 1, 5


def validate_rows(df: DataFrame, defaults: dict, int_ge0: Sequence[str] = (),
                  state_col: str | None = None, unique_from: tuple[str, str] | None = None):
    """Apply the request rules to a batch; return (valid, rejected) frames.

    * missing values take the defaults;
    * integer fields must be >= 0;
    * ``state_col`` is trimmed and must have 1..5 characters;
    * ``unique_from=(target, source)`` fills an empty target with the source
      (``x or y``: NULL and '' both count as empty).

    ``rejected`` carries a ``reason`` column; nothing is raised, a batch is
    split instead of failing request by request.
    """
    out = df
    for c, v in defaults.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    if unique_from is not None:
        tgt, src = unique_from
        out = out.withColumn(tgt, F.coalesce(F.nullif(F.col(tgt), F.lit("")), F.col(src)))
    reasons = []
    for c in int_ge0:
        reasons.append(F.when(F.col(c) < 0, F.lit(f"{c} must be >= 0")))
    if state_col is not None:
        out = out.withColumn(state_col, F.trim(F.col(state_col)))
        n = F.length(F.col(state_col))
        reasons.append(F.when((n < STATE_MIN_LEN) | (n > STATE_MAX_LEN),
                              F.lit(f"{state_col} length must be {STATE_MIN_LEN}..{STATE_MAX_LEN}")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    marked = out.withColumn("reason", reason)
    valid = marked.where(F.col("reason") == "").drop("reason")
    rejected = marked.where(F.col("reason") != "")
    return valid, rejected


def table_count(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Number of user tables and views in the catalog (one row)."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return spark.createDataFrame([(len(names),)], "tables_total long")


def rows_total(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact total row count over the given tables (one row)."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")) for df in tables.values()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.agg(F.sum("n").alias("rows_total"))
