"""Every registered query against its DuckDB oracle, plus plan-shape checks."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from emporium.plans.registry import registered
from oracle_check import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = set()
    # (the training-data operators have tests of their own)
    assert set(registered()) - set(ORACLES) == rows_only
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "monthly_revenue"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle_sf0001(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES.get(name), SF001, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_anchor_values_sf001(spark):
    q = QUERIES
    months = q["q11_monthly_revenue"](spark, SF01).collect()
    assert len(months) == 80
    assert months[0].monthly_revenue == 41204711.66
    assert q["q09_late_delivery_percent"](spark, SF01).first()[0] == 75.86
    assert q["q17_delivery_vs_total"](spark, SF01).count() == 317
    assert q["q35_top3_price_rank"](spark, SF01).count() == 78
    first = q["q15_review_by_category_min50"](spark, SF01).first()
    assert (first.category, first.avg_score, first.n_reviews) == ("brand_13", 3.16, 556)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    q = QUERIES
    top = _plan(q["q03_top_cities"](spark, SF01))
    assert "TakeOrderedAndProject" in top
    rank = _plan(q["q35_top3_price_rank"](spark, SF01))
    assert "WindowGroupLimit" in rank
    for name in QUERIES:
        if name.startswith(("q", "points", "metrics", "quality", "dml")):
            assert "CartesianProduct" not in _plan(QUERIES[name](spark, SF001)), name


def test_unused_delivery_join_is_pruned(spark):
    plan = _plan(QUERIES["q01_monthly_items_revenue"](spark, SF01))
    # orders is read for its purchase time only: the line-item aggregate that
    # derives the delivery date and the item-number window are both removed
    assert "l_shipdate" not in plan
    assert "Window" not in plan


@pytest.mark.parametrize("name", ["q04_top_categories_revenue", "q07_avg_order_total_by_state",
                                  "q08_top_sellers", "q10_top_categories_items",
                                  "q11_monthly_revenue", "q18_state_order_totals"])
def test_lines_are_aggregated_below_the_joins(spark, name):
    """A hot order, seller or product reaches a join as one row."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    rows = plan.splitlines()
    depth = [len(r) - len(r.lstrip(" :+-")) for r in rows]
    scans = [i for i, r in enumerate(rows) if "l_" in r and "Relation" in r]
    assert scans
    for at in scans:
        above, level = [], depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] < level:
                above.append(rows[i])
                level = depth[i]
        kinds = [k for r in above for k in ("Aggregate", "Join") if f"{k} " in r]
        assert kinds[0] == "Aggregate", plan


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def test_oracle_column_types_equal_spark_types(spark, con):
    for name, sql in ORACLES.items():
        duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        for col, t in QUERIES[name](spark, SF001).dtypes:
            assert SPARK_TO_DUCK.get(t, t) == duck_types.get(col), (name, col, t, duck_types.get(col))


@pytest.mark.parametrize("name,bounds", [
    ("q14_category_year_revenue", 2), ("q14b_category_year_top10", 2), ("q19_orders_by_month_year", 2),
    ("q19b_month_by_year_pivot", 2), ("q36_recent_daily_orders", 1), ("q40_last_day_and_count", 1),
    ("q40_last_day_and_count_sql", 1)])
def test_time_range_reaches_the_scan(spark, name, bounds):
    """The purchase time is derived; the bounds it implies for the stored date are pushed down."""
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert pushed and all(len(re.findall(r"(GreaterThan|LessThan)\w*\(o_orderdate", line)) == bounds for line in pushed)
