"""Report semantics on hand-written micro tables (FIXTURES.md §C)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from emporium.plans import reports as R

T = dt.datetime


class MiniStar:
    """A star schema of small in-memory tables (unset tables are empty)."""

    SCHEMAS = {
        "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
                     "customer_city string, customer_state string",
        "orders": "order_id string, customer_id string, order_status string, "
                  "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                  "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
                  "order_estimated_delivery_date timestamp_ntz",
        "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
                       "shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)",
        "order_payments": "order_id string, payment_sequential int, payment_type string, "
                          "payment_installments int, payment_value decimal(10,2)",
        "order_reviews": "review_id string, order_id string, review_score int",
        "products": "product_id string, product_category_name string",
        "translation": "product_category_name string, product_category_name_english string",
        "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
        "geolocation": "geolocation_zip_code_prefix int, geolocation_lat decimal(10,6), "
                       "geolocation_lng decimal(10,6), geolocation_city string, geolocation_state string",
    }

    def __init__(self, spark, **tables):
        self.spark = spark
        for name, schema in self.SCHEMAS.items():
            setattr(self, name, spark.createDataFrame(tables.get(name, []), schema))

    def table(self, name):
        return getattr(self, name)


def _order(oid, ts, cust="c1", status="delivered", delivered=None, estimated=None):
    return (oid, cust, status, ts, None, None, delivered, estimated)


def _item(oid, n, pid="p1", price="10.00", freight="1.00", seller="s1"):
    return (oid, n, pid, seller, None, Decimal(price), Decimal(freight))


def test_fanout_totals_and_counts(spark):
    s = MiniStar(spark,
                 orders=[_order("o1", T(2020, 1, 5))],
                 order_items=[_item("o1", 1), _item("o1", 2, price="20.00", freight="2.00")],
                 order_payments=[("o1", i, "boleto", 1, Decimal("1.00")) for i in (1, 2, 3)])
    # order total is tripled by the 3 payments
    assert rows(R.q16_per_order_totals(s)) == [("o1", 99.0)]
    # payments x items = 6
    assert rows(R.q12_payment_fanout_counts(s)) == [("boleto", 6)]


def test_rank_ties_and_null_price_first(spark):
    items = [_item("o1", i, pid=f"p{i}", price=p) for i, p in
             enumerate(["50.00", "50.00", "40.00", "40.00", "30.00"], start=1)]
    items.append(("o1", 9, "p9", "s1", None, None, Decimal("1.00")))
    s = MiniStar(spark, order_items=items,
                 products=[(f"p{i}", "cat") for i in (1, 2, 3, 4, 5, 9)])
    got = [r[1] for r in R.q35_top3_price_rank(s).collect()]
    # NULL price ranks first under DESC (PostgreSQL), then 50, 50 tie at 2,
    # the next rank skips to 4: three rows have rank <= 3
    assert sorted(got) == [1, 2, 2]


def test_null_order_in_lookup(spark):
    s = MiniStar(spark, customers=[("c1", "u1", 1, "X", "S")],
                 orders=[_order("o1", None), _order("o2", T(2020, 1, 1)), _order("o3", T(2021, 1, 1))])
    got = [r.order_id for r in R.q37_orders_by_customer(s, "c1").collect()]
    assert got == ["o3", "o2", "o1"]  # DESC NULLS LAST


def test_gap_series_zero_fill_and_frames(spark):
    s = MiniStar(spark,
                 customers=[("c1", "u", 1, "x", "A"), ("c2", "u", 1, "y", "B")],
                 orders=[_order("o1", T(2020, 1, 3), "c1"), _order("o2", T(2020, 4, 3), "c1"),
                         _order("o3", T(2020, 1, 9), "c2"), _order("o4", T(2020, 4, 9), "c2")])
    filled = rows(R.q20b_series_zero_filled(s))
    assert len(filled) == 2 * 4   # |states| x |months|
    assert ("A", dt.date(2020, 2, 1), 0) in filled and ("B", dt.date(2020, 3, 1), 0) in filled
    frames = R.q20c_cumulative_frames(s)
    per_frame = {r[0]: r[1] for r in frames.groupBy("frame").agg(F.count(F.lit(1))).collect()}
    assert per_frame == {dt.date(2020, m, 1): 2 * m for m in (1, 2, 3, 4)}
    bad = frames.where(F.col("month") > F.col("frame")).count()
    assert bad == 0
    axis = R.q20d_axis_range(s).first()
    assert axis.x_min == dt.date(2020, 1, 1) and axis.x_max == dt.date(2020, 4, 1)
    assert axis.y_max == 1 * 1.1


def test_top_rows_then_top_groups(spark):
    # category A dominates one year only; B and C spread over three years.
    # The 3 best (category, year) rows are A-1997, B-1996, C-1996; ranked by
    # those rows only, the top 2 categories are A and C - globally B would win.
    orders, items, products = [], [], []
    plan = [("A", 1997, "100.00"), ("B", 1996, "60.00"), ("B", 1997, "55.00"), ("B", 1998, "55.00"),
            ("C", 1996, "70.00"), ("C", 1997, "10.00")]
    for i, (cat, year, price) in enumerate(plan):
        orders.append(_order(f"o{i}", T(year, 6, 1)))
        items.append(_item(f"o{i}", 1, pid=f"p{i}", price=price))
        products.append((f"p{i}", cat))
    s = MiniStar(spark, orders=orders, order_items=items, products=products)
    top = R.q14b_category_year_top10(s, k_rows=3, k_groups=2)
    got = rows(top)
    cats = {r[0] for r in got}
    assert cats == {"A", "C"}
    assert ("A", 1996, 0.0) in got and ("A", 1997, 100.0) in got and ("C", 1996, 70.0) in got
    assert ("C", 1997, 0.0) in got   # outside the 3 top rows, so 0 in the grid


def test_city_wildcards(spark):
    s = MiniStar(spark,
                 customers=[("c1", "u", 1, "São Paulo", "SP"), ("c2", "u", 1, "SÃO PAULO", "SP"),
                            ("c3", "u", 1, "Sao Paulo", "SP")],
                 orders=[_order(f"o{i}", T(2020, 1, i), f"c{i}") for i in (1, 2, 3)])
    assert len(R.q38_orders_by_city(s, "são paulo").collect()) == 2
    assert len(R.q38_orders_by_city(s, "S_o%").collect()) == 3
    assert len(R.q38_orders_by_city(s, "S_o%", exact=True).collect()) == 0
    assert len(R.q38_orders_by_city(s, "sao paulo", exact=True).collect()) == 1


def test_share_sums_to_100(spark):
    pays = [(f"o{i}", 1, t, 1, Decimal("1.00")) for i, t in
            enumerate(["a"] * 3 + ["b"] * 5 + ["c"] * 7)]
    s = MiniStar(spark, order_payments=pays)
    got = rows(R.q06_payment_type_share(s))
    assert got == [("a", 3, 20.0), ("b", 5, 33.33), ("c", 7, 46.67)]
    assert abs(sum(r[2] for r in got) - 100) < 0.01 * len(got)


def test_last_day_fallback(spark):
    s = MiniStar(spark, orders=[_order("99", T(2020, 1, 1))])
    r = R.q40_last_day_and_count(s, id_prefix="12", start="2020-01-01").first()
    assert (r.last_day, r.cnt) == (dt.date(2019, 12, 31), 0)
    r = R.q39_last_order_day(s, id_prefix="12", fallback="2016-09-01").first()
    assert r.last_day == dt.date(2016, 9, 1)


def test_avg_delivery_interval(spark):
    s = MiniStar(spark, orders=[_order("o1", T(2020, 1, 1), delivered=T(2020, 1, 3)),
                                _order("o2", T(2020, 1, 1), delivered=T(2020, 1, 2, 12))])
    r = R.q02_avg_delivery_time(s, with_interval=True).first()
    assert r.avg_delivery_days == 1.75
    assert r.avg_delivery_time == dt.timedelta(days=1, hours=18)


def test_avg_delivery_time_of_a_sum_beyond_bigint(spark):
    # 40 orders of 3.2e17 microseconds each: their sum is above 2 ** 63
    long_ago, late = T(1, 1, 1), T(9999, 1, 1)
    s = MiniStar(spark, orders=[_order(f"o{i}", long_ago, delivered=late) for i in range(40)])
    r = R.q02_avg_delivery_time(s).first()
    assert r.avg_delivery_days == (late - long_ago).days
    assert R.q02_avg_delivery_time(MiniStar(spark)).first().avg_delivery_days is None
