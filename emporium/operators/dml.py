"""UPDATE and DELETE as DataFrame → new-table-version jobs.

Parquet tables cannot be updated in place, so a statement becomes a
projection of the old version: rows hit by the statement get their new
values through ``when(hit, new).otherwise(old)``, a delete is an anti-join.
The reference targets its statements with ``key IN (SELECT key ... ORDER
BY ... LIMIT k)``; here the target set is a LIMITed frame, whose size bound
of k rows Catalyst proves (``maxRows``), so it is joined by broadcast.  Without
a pick, the predicate alone marks the rows and no join happens at all.

Random choices (``ORDER BY random()``, ``random() * 10``) are seeded
hashes of the row key (see ``functions.picks``): a retried task or a rerun
job changes the same rows in the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions.picks import seeded_key, seeded_uniform
from emporium.functions.predicates import like_prefix
from emporium.functions.time import relative_time, ts_literal
from emporium.operators.bounds import broadcast_if_bounded
from emporium.operators.topk import top_k
from emporium.operators.upsert import TableChange, _keys

_HIT = "__hit"


class ForeignKey(NamedTuple):
    """``child(columns)`` references ``parent(key)``."""

    child: str
    columns: str | Sequence[str]
    parent: str
    key: str | Sequence[str]


def _mark(target: DataFrame, where: Column | None, picked: DataFrame | None,
          key: Sequence[str]) -> DataFrame:
    cond = where if where is not None else F.lit(True)
    if picked is None:
        return target.withColumn(_HIT, F.coalesce(cond, F.lit(False)))
    # a LIMITed pick is bounded by k rows and broadcast; an unbounded key set
    # is left to the planner's size-based choice
    keys = broadcast_if_bounded(picked.select(*key).distinct().withColumn("__picked", F.lit(True)))
    j = target.join(keys, list(key), "left")
    return (j.withColumn(_HIT, F.coalesce(cond & F.col("__picked"), F.lit(False)))
            .drop("__picked"))


def update_where(target: DataFrame, assignments: Mapping[str, Column],
                 where: Column | None = None, picked: DataFrame | None = None,
                 key: str | Sequence[str] | None = None) -> TableChange:
    """``UPDATE target SET col = expr, ... WHERE where [AND key IN (picked)]``.

    Assignment expressions see the old row; they are cast to the column's
    type with PostgreSQL's assignment rules (see :func:`assign_cast`).
    """
    cols = target.columns
    types = dict(target.dtypes)
    keys = _keys(key) if key is not None else []
    marked = _mark(target, where, picked, keys)
    hit = F.col(_HIT)
    given = dict(marked.select(*(e.alias(c) for c, e in assignments.items())).dtypes)
    out = [F.when(hit, assign_cast(assignments[c], types[c], given[c])).otherwise(F.col(c)).alias(c)
           if c in assignments else F.col(c) for c in cols]
    new_version = marked.select(*out)
    changed = marked.where(hit).select(*out)
    return TableChange(new_version, changed)


def assign_cast(expr: Column, type_name: str, given: str = "double") -> Column:
    """Store a value of type ``given`` into a column of ``type_name`` as an
    assignment would.

    Into an integer, a floating value rounds half to even and a decimal half
    away from zero, and an integer stays exact; into a decimal, values round
    half away from zero to the column's scale; other types are cast.
    """
    if type_name in ("int", "bigint", "smallint", "tinyint"):
        if given in ("double", "float"):
            return F.rint(expr).cast(type_name)
        return (F.round(expr, 0) if given.startswith("decimal") else expr).cast(type_name)
    if type_name.startswith("decimal"):
        scale = int(type_name.split(",")[1].rstrip(")"))
        return F.round(expr, scale).cast(type_name)
    return expr.cast(type_name)


def delete_where(target: DataFrame, key: str | Sequence[str],
                 where: Column | None = None, picked: DataFrame | None = None,
                 children: Sequence[tuple[DataFrame, str | Sequence[str]]] = (),
                 on_child: str = "restrict") -> TableChange:
    """``DELETE FROM target WHERE where [AND key IN (picked)]``.

    ``children`` are (table, foreign-key columns) pairs pointing at ``key``.
    ``on_child='restrict'`` makes the job fail, like a foreign key without
    ON DELETE, when a deleted row still has children; the check runs inside
    the job (a scalar subquery feeding ``assert_true``), so nothing is
    written when it fails.  ``'rollback'`` models the reference's caller,
    which catches that error and rolls back: the table stays unchanged and
    no row counts as deleted.  ``'ignore'`` deletes regardless.  Deleting
    along with the child rows is :func:`delete_cascade`.
    """
    keys = _keys(key)
    marked = _mark(target, where, picked, keys)
    hit = F.col(_HIT)
    deleted = marked.where(hit).drop(_HIT)
    if on_child not in ("restrict", "rollback", "ignore"):
        raise ValueError(f"on_child must be 'restrict', 'rollback' or 'ignore', got {on_child!r}")
    if on_child == "ignore" or not children:
        return TableChange(marked.where(~hit).drop(_HIT), deleted)
    n_child = None
    for child, fk in children:
        fk_cols = _keys(fk)
        cond = [child[f] == deleted[k] for f, k in zip(fk_cols, keys)]
        n = child.join(deleted.select(*keys), cond, "left_semi").agg(F.count(F.lit(1))).scalar()
        n_child = n if n_child is None else n_child + n
    if on_child == "restrict":
        guard = F.coalesce(F.assert_true(n_child == 0, F.lit(
            "update or delete violates foreign key constraint")).cast("boolean"), F.lit(True))
        return TableChange(marked.where(~hit & guard).drop(_HIT), deleted)
    # rollback: the failing statement leaves the table as it was
    violated = n_child > 0
    return TableChange(marked.where(~hit | violated).drop(_HIT), deleted.where(~violated))


def delete_children(child: DataFrame, fk: str | Sequence[str], deleted: DataFrame,
                    key: str | Sequence[str]) -> TableChange:
    """New version of a child table without the rows of deleted parents (cascade)."""
    fk_cols, keys = _keys(fk), _keys(key)
    parents = deleted.select(*[F.col(k).alias(f) for k, f in zip(keys, fk_cols)])
    return TableChange(child.join(parents, fk_cols, "left_anti"),
                       child.join(parents, fk_cols, "left_semi"))


def delete_cascade(tables: Mapping[str, DataFrame], root: str, deleted: DataFrame,
                   foreign_keys: Sequence[ForeignKey]) -> dict[str, TableChange]:
    """``DELETE`` from ``root`` with ``ON DELETE CASCADE`` along the foreign keys.

    ``deleted`` holds the rows of ``root`` to delete (from its unique key on).  The
    deletion goes from parent to child table: a child row goes when any of its
    foreign keys names a deleted row; a NULL foreign key names none.  Every
    table that can be reached from ``root`` gets a change, to be published
    together (``sinks.publish_tables``).  Foreign keys in a circle raise
    ``ValueError``.

    One join per foreign key, of the child with the distinct deleted keys: as
    many rows as are deleted, left to the planner to broadcast or shuffle.
    """
    changes: dict[str, TableChange] = {}
    for name in _parents_first(root, foreign_keys):
        incoming = [fk for fk in foreign_keys if fk.child == name and fk.parent in changes]
        marked, hit = tables[name], F.lit(False)
        if name == root:
            keys = sorted({c for fk in foreign_keys if fk.parent == root for c in _keys(fk.key)}) or deleted.columns
            marked = marked.join(deleted.select(*keys).distinct().withColumn("__gone", F.lit(True)), keys, "left")
            hit = F.col("__gone").isNotNull()
        for i, fk in enumerate(incoming):
            own = _keys(fk.columns)
            gone = changes[fk.parent].changed.select(*(F.col(k).alias(f"__k{j}") for j, k in enumerate(_keys(fk.key)))) \
                .distinct().withColumn(f"__gone{i}", F.lit(True))
            same = [marked[c] == gone[f"__k{j}"] for j, c in enumerate(own)]
            marked = marked.join(gone, same, "left").drop(*(f"__k{j}" for j in range(len(own))))
            hit = hit | F.col(f"__gone{i}").isNotNull()
        columns = tables[name].columns
        changes[name] = TableChange(marked.where(~hit).select(*columns), marked.where(hit).select(*columns))
    return changes


def _parents_first(root: str, foreign_keys: Sequence[ForeignKey]) -> list[str]:
    """The tables that ``root``'s deletions reach, each after all its reached parents."""
    reached = [root]
    for name in reached:
        reached += sorted({fk.child for fk in foreign_keys if fk.parent == name} - set(reached))
    order: list[str] = []
    while len(order) < len(reached):
        ready = [n for n in reached if n not in order
                 and all(fk.parent in order for fk in foreign_keys if fk.child == n and fk.parent in reached)]
        if not ready:
            raise ValueError(f"foreign keys in a circle: {sorted(set(reached) - set(order))}")
        order += ready
    return order


# ------------------------------------------------- the reference's statements
def u1_mark_delivered(orders: DataFrame, as_of: str, k: int = 5,
                      min_age_days: int = 2) -> TableChange:
    """Oldest k shipped orders older than ``min_age_days`` become delivered now."""
    now = ts_literal(as_of)
    cond = ((F.col("order_status") == "shipped")
            & (F.col("order_purchase_timestamp") < relative_time(as_of, days=min_age_days)))
    picked = top_k(orders.where(cond), k, ["order_purchase_timestamp", "order_id"])
    return update_where(orders, {"order_status": F.lit("delivered"),
                                 "order_delivered_customer_date": now},
                        where=cond, picked=picked, key="order_id")


def u2_products(products: DataFrame, id_prefix: str, k: int = 3, seed: int = 1) -> TableChange:
    """k seeded-random products with the id prefix: weight + U·10, photos − 1 (≥ 1)."""
    cond = like_prefix("product_id", id_prefix)
    picked = top_k(products.where(cond), k, [seeded_key(F.col("product_id"), seed), "product_id"])
    jitter = seeded_uniform(F.col("product_id"), seed + 1) * F.lit(10.0)
    return update_where(products, {
        "product_weight_g": F.col("product_weight_g") + jitter,
        "product_photos_qty": F.greatest(F.lit(1), F.col("product_photos_qty") - 1),
    }, picked=picked, key="product_id")


def u3_price_jitter(items: DataFrame, orders: DataFrame, as_of: str, k: int = 10,
                    window_hours: int = 1, seed: int = 3) -> TableChange:
    """Items of the k oldest orders of the last hour: price × (0.9 + U·0.2)."""
    recent = orders.where(F.col("order_purchase_timestamp")
                          > relative_time(as_of, hours=window_hours))
    picked = top_k(recent, k, ["order_purchase_timestamp", "order_id"]).select("order_id")
    u = seeded_uniform(F.concat_ws("/", F.col("order_id"), F.col("order_item_id").cast("string")), seed)
    # the factor is fixed to 10 decimals so the product is exact DECIMAL math
    factor = (F.lit(0.9) + u * F.lit(0.2)).cast("decimal(12,10)")
    return update_where(items, {"price": F.col("price") * factor}, picked=picked, key="order_id")


# Fixed values of the reference's rename statement.
CITY_RENAMES = {"Sao Paulo": "São Paulo", "Rio de Janeiro": "Rio"}


def u4_city_rename(customers: DataFrame, id_prefix: str, renames: Mapping[str, str] = CITY_RENAMES,
                   k: int = 8, seed: int = 4) -> TableChange:
    """k seeded-random customers with the id prefix: CASE rename of their city."""
    cond = like_prefix("customer_id", id_prefix)
    picked = top_k(customers.where(cond), k, [seeded_key(F.col("customer_id"), seed), "customer_id"])
    city = F.col("customer_city")
    expr = None
    for old, new in renames.items():
        expr = (F.when(city == F.lit(old), F.lit(new)) if expr is None
                else expr.when(city == F.lit(old), F.lit(new)))
    expr = city if expr is None else expr.otherwise(city)
    return update_where(customers, {"customer_city": expr}, picked=picked, key="customer_id")


def u5_installments(payments: DataFrame, k: int = 6, seed: int = 5,
                    payment_type: str = "credit_card") -> TableChange:
    """Credit-card payments of the orders of k seeded-random credit-card payment rows:
    installments + 1, value × 1.1.  The pick is over payment rows, so an order
    picked twice is updated once."""
    cond = F.col("payment_type") == F.lit(payment_type)
    row_key = F.concat_ws("/", F.col("order_id"), F.col("payment_sequential").cast("string"))
    picked = top_k(payments.where(cond), k, [seeded_key(row_key, seed), "order_id",
                                             "payment_sequential"]).select("order_id")
    return update_where(payments, {
        "payment_installments": F.col("payment_installments") + 1,
        "payment_value": F.col("payment_value") * F.lit(1.1).cast("decimal(2,1)"),
    }, where=cond, picked=picked, key="order_id")


def delete_stale_orders(orders: DataFrame, as_of: str, id_prefix: str, k: int = 15,
                        min_age_hours: int = 1, children=(), on_child: str = "restrict") -> TableChange:
    """The oldest k orders with the id prefix older than ``min_age_hours``."""
    cond = (like_prefix("order_id", id_prefix)
            & (F.col("order_purchase_timestamp") < relative_time(as_of, hours=min_age_hours)))
    picked = top_k(orders.where(cond), k, ["order_purchase_timestamp", "order_id"])
    return delete_where(orders, "order_id", where=cond, picked=picked,
                        children=children, on_child=on_child)
