"""Idempotent loading: insert-if-absent, append with key check, first-wins dedupe.

The reference loads every table with ``INSERT ... SELECT ... ON CONFLICT
(key) DO NOTHING`` against a unique index.  Parquet tables have no index, so
each load returns the *new table version* as a DataFrame; the caller
publishes it (see ``operators.sinks.publish_tables``).  Semantics kept:

* inside one batch the first row of a key wins; "first" is an explicit
  ordering (Spark rows have no order), by default the smallest row;
* a row whose key already exists in the target is skipped, the stored row is
  never changed, so loading the same batch twice equals loading it once;
* a key containing NULL never conflicts (a unique index treats NULLs as
  distinct), so such rows are neither de-duplicated nor skipped.

Scale: de-duplication is an aggregation (the least row per key) rather than a
window, so every partition collapses its copies of a key before the
shuffle: a key that holds a third of the batch costs one row per partition,
not one sorted partition holding a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, IntegralType, MapType, StringType,
                               TimestampNTZType, TimestampType)

#: Types whose equal values are the same value (unlike 0.0 and -0.0).
_ONE_FORM = (IntegralType, DecimalType, BooleanType, BinaryType, DateType, TimestampType, TimestampNTZType)


@dataclass
class TableChange:
    """A new table version plus the rows the statement touched."""

    table: DataFrame
    changed: DataFrame

    def rowcount(self) -> int:
        """``cursor.rowcount`` of the statement (runs a count job)."""
        return self.changed.count()


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def first_wins(df: DataFrame, key: str | Sequence[str],
               order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per non-NULL key: the first by ``order_by`` (default: whole row).

    Rows with a NULL in the key are kept as they are.  ``order_by`` should be
    a total order (end with a unique column, e.g. a source position) to make
    the winner reproducible; exact duplicates are interchangeable anyway.
    """
    nullable = _any_null(_keys(key))
    return first_of_keys(df.where(~nullable), key, order_by).unionByName(df.where(nullable))


def first_of_keys(df: DataFrame, key: str | Sequence[str],
                  order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """:func:`first_wins` of rows whose keys hold no NULL."""
    keys = _keys(key)
    cols = df.columns
    order = [F.col(c) if isinstance(c, str) else c for c in (order_by or [])]
    named = {c for c in (order_by or []) if isinstance(c, str)}
    types = {f.name: f.dataType for f in df.schema.fields}
    whole = not any(isinstance(t, MapType) for t in types.values())
    # a key column of these types has one value in a group, so it need not be carried in it
    alike = {k for k in keys if whole and (isinstance(types[k], _ONE_FORM) or types[k] == StringType())}
    # rank by the ordering first, the rest of the row second, so ties are
    # broken the same way on every run (map columns cannot be ordered)
    rest = [c for c, t in types.items() if c not in named | alike and not isinstance(t, MapType)]
    ranked = [*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)]]
    groups = df.groupBy(*keys)
    if not whole:
        row = F.struct(*[F.col(c) for c in cols])
        return groups.agg(F.min_by(row, F.struct(*ranked)).alias("_row")).select("_row.*")
    if not ranked:  # all columns are key
        return df.distinct()
    # the rank holds the row: a group carries it once
    at = {c: f"_o{i}" for i, c in enumerate(order_by or []) if isinstance(c, str)} \
        | {c: f"_r{i}" for i, c in enumerate(rest)}
    return groups.agg(F.min(F.struct(*ranked)).alias("_first")) \
        .select(*[F.col(c) if c in alike else F.col(f"_first.{at[c]}").alias(c) for c in cols])


def insert_if_absent(target: DataFrame, new: DataFrame, key: str | Sequence[str],
                     order_by: Sequence[Column | str] | None = None,
                     dedupe: bool = True) -> TableChange:
    """``INSERT INTO target SELECT new ON CONFLICT (key) DO NOTHING``.

    ``dedupe=False`` skips the in-batch first-row-wins step for a batch whose
    keys are already unique.
    """
    keys = _keys(key)
    new = new.select(*target.columns)
    batch = first_wins(new, keys, order_by) if dedupe else new
    existing = target.select(*keys).where(~_any_null(keys))
    inserted = batch.join(existing, keys, "left_anti").select(*target.columns)
    return TableChange(target.unionByName(inserted), inserted)


def insert_distinct_if_absent(target: DataFrame, new: DataFrame) -> TableChange:
    """Load with a unique index on *all* columns: ``SELECT DISTINCT`` + skip existing.

    NULL-containing rows never conflict, as with a unique index.
    """
    cols = target.columns
    batch = new.select(*cols).distinct()
    nullable = _any_null(cols)
    keyed = batch.where(~nullable).join(target.where(~nullable), cols, "left_anti")
    inserted = keyed.unionByName(batch.where(nullable)).select(*cols)
    return TableChange(target.unionByName(inserted), inserted)


def duplicate_key_guard(target: DataFrame, new: DataFrame, key: str | Sequence[str]) -> Column:
    """Boolean column that raises when ``new`` repeats a key (in itself or in target)."""
    keys = _keys(key)
    in_batch = (new.groupBy(*keys).count().where(F.col("count") > 1)
                .agg(F.count(F.lit(1))).scalar())
    in_target = (new.select(*keys).join(target.select(*keys), keys, "left_semi")
                 .agg(F.count(F.lit(1))).scalar())
    ok = (in_batch + in_target) == 0
    return F.coalesce(F.assert_true(ok, F.lit("duplicate key value violates unique constraint"))
                      .cast("boolean"), F.lit(True))


def append(target: DataFrame, new: DataFrame, key: str | Sequence[str]) -> TableChange:
    """Plain ``INSERT``: fails (when the result is computed) on a duplicate key."""
    new = new.select(*target.columns)
    guarded = new.where(duplicate_key_guard(target, new, key))
    return TableChange(target.unionByName(guarded), guarded)


def append_order(orders: DataFrame, items: DataFrame, payments: DataFrame,
                 new_orders: DataFrame, new_items: DataFrame,
                 new_payments: DataFrame) -> tuple[TableChange, TableChange, TableChange]:
    """Insert orders with their items and payments (one statement each).

    Keys must be new (a duplicate raises when the result is computed) and
    every new item and payment must belong to an order of the table after
    the insert (a foreign-key violation raises the same way).
    """
    o = append(orders, new_orders, "order_id")
    parents = o.table.select("order_id")
    out = [o]
    for table, new, key in ((items, new_items, ["order_id", "order_item_id"]),
                            (payments, new_payments, ["order_id", "payment_sequential"])):
        orphans = (new.select("order_id").join(parents, "order_id", "left_anti")
                   .agg(F.count(F.lit(1))).scalar())
        guard = F.coalesce(F.assert_true(orphans == 0, F.lit(
            "insert or update violates foreign key constraint")).cast("boolean"), F.lit(True))
        ch = append(table, new.where(guard), key)
        out.append(ch)
    return out[0], out[1], out[2]
