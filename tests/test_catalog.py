"""Bucketed catalog tables: reports run unchanged, order joins do not shuffle."""

from __future__ import annotations

from conftest import SF001, rows
from emporium.plans import reports as R
from emporium.sources.catalog import CatalogStar, save_bucketed
from emporium.sources.testdata import Star


def test_bucketed_tables_co_locate_order_joins(spark):
    star = Star(spark, SF001)
    save_bucketed(spark, star, "emporium_test_db", buckets=4)
    cat = CatalogStar(spark, "emporium_test_db")
    # same results as over the derived tables
    for report in (R.q11_monthly_revenue, R.q16_per_order_totals, R.q07_avg_order_total_by_state):
        assert rows(report(cat)) == rows(report(star))
    # orders ⋈ items aggregated per order, as a sort-merge join (broadcasts
    # off): the bucketed sides need no exchange at all
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = cat.orders.select("order_id", "order_purchase_timestamp")
        per_order = o.join(cat.order_lines.select("order_id", "price"), "order_id") \
            .groupBy("order_id").count()
        plan = per_order._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan
        # the same join over the derived (unbucketed) tables shuffles both sides
        o2 = star.orders.select("order_id", "order_purchase_timestamp")
        plain = o2.join(star.order_lines.select("order_id", "price"), "order_id")
        assert "Exchange hashpartitioning" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_reach_the_scan_on_published_tables(spark):
    cat = CatalogStar(spark, "emporium_test_db")
    if not spark.catalog.tableExists("emporium_test_db.orders"):
        save_bucketed(spark, Star(spark, SF001), "emporium_test_db", buckets=4)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # untruncated filter lists
    try:
        lookup = R.q37_orders_by_customer(cat, "100")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(customer_id,100)" in lookup
        years = R.q14_category_year_revenue(cat)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(order_purchase_timestamp" in years
        assert "LessThan(order_purchase_timestamp" in years
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
