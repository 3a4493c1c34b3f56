"""

Each report is a function of a :class:`~emporium.sources.testdata.Star`
(or any object exposing the same nine logical tables) plus parameters that
the reference hard-coded (years, "now", row limits, lookup values).  All
results end in DOUBLE, BIGINT, INT, DATE or strings: money is summed as
DECIMAL and cast last, rounded ratios use exact integer arithmetic.

Ties under LIMIT are broken by the group key so results are reproducible.
PostgreSQL sorts NULL first under DESC and last under ASC; the sort keys
say so explicitly because Spark's defaults are the opposite.

Scale notes: fan-out joins that the reference uses only to multiply counts
(payments x items) are computed from per-order pre-aggregates, which gives
the same numbers without materialising the fan-out rows; many-to-many
joins (geolocation x customers on ZIP) multiply per-key counts instead of
emitting pairs.  Dense grids and animation frames are generated with
``sequence`` + ``explode`` on already-aggregated rows instead of joins.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.functions.predicates import (between_filter, eq_filter, ilike_match, in_list,
                                           late_flag, like_prefix, not_null, range_cmp)
from emporium.functions.time import interval_from_micros, relative_time
from emporium.functions import (days_between, exact_mean, micros_between,
                                month_start, percent, round_money_mean,
                                round_ratio, ts_literal, year_range)
from emporium.operators.densify import densify_months, densify_with_frames
from emporium.operators.share import with_share
from emporium.operators.topk import isin_top_k, top_k

# Parameters the reference hard-coded, re-based on the test data
# (orders run 1995-01-01 .. 2001-08-01).
YEARS = (1996, 1997, 1998)
AS_OF = "2001-08-01 12:00:00"


def lines(s) -> DataFrame:
    """Order items without the item number: reports never read it, and a
    star that derives the number (see ``Star.order_items``) can skip that work."""
    view = getattr(s, "order_lines", None)
    return s.order_items if view is None else view


def orders_between(s, since=None, until=None) -> DataFrame:
    """Orders that the caller's exact filter on the purchase time can keep: a star
    that derives the time (see ``Star.orders_between``) bounds what it scans."""
    view = getattr(s, "orders_between", None)
    return s.orders if view is None else view(since, until)


def _item_total() -> F.Column:
    return F.col("price") + F.col("freight_value")


# ------------------------------------------------------ the ten core reports
def q01_monthly_items_revenue(s) -> DataFrame:
    o = s.orders.select("order_id", "order_purchase_timestamp")
    oi = lines(s).select("order_id", "price", "freight_value")
    return (
        o.join(oi, "order_id")
        .groupBy(month_start(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.count(F.lit(1)).alias("total_orders"),
             F.sum(_item_total()).cast("double").alias("total_revenue"))
        .orderBy("month")
    )


def q02_avg_delivery_time(s, with_interval: bool = False) -> DataFrame:
    """AVG(delivered - purchased): exact sum of microseconds / count, as
    seconds and days (and, on request, as a day-time INTERVAL)."""
    o = s.orders.where(F.col("order_delivered_customer_date").isNotNull())
    # a BIGINT sum of microseconds overflows at about 600,000 orders of half a year each
    us = micros_between(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")) \
        .cast("decimal(20,0)")
    mean = exact_mean(F.col("us"), F.col("n"))
    cols = [(mean / F.lit(1e6)).alias("avg_delivery_seconds"),
            (mean / F.lit(86400e6)).alias("avg_delivery_days")]
    if with_interval:
        cols.append(interval_from_micros(mean).alias("avg_delivery_time"))
    return o.agg(F.sum(us).alias("us"), F.count(us).alias("n")).select(*cols)


def q03_top_cities(s, k: int = 10) -> DataFrame:
    o = s.orders.select("order_id", "customer_id")
    c = s.customers.select("customer_id", "customer_city")
    counts = (o.join(c, "customer_id").groupBy("customer_city")
              .agg(F.count("order_id").alias("order_count")))
    return top_k(counts, k, [F.col("order_count").desc_nulls_first(),
                             F.col("customer_city").asc_nulls_last()])


def q04_top_categories_revenue(s, k: int = 10) -> DataFrame:
    oi = lines(s).groupBy("product_id").agg(F.sum("price").alias("price"))
    p = s.products.select("product_id", "product_category_name")
    rev = (oi.join(p, "product_id").groupBy("product_category_name")
           .agg(F.sum("price").alias("rev")))
    top = top_k(rev, k, [F.col("rev").desc_nulls_first(),
                         F.col("product_category_name").asc_nulls_last()])
    return top.select("product_category_name", F.col("rev").cast("double").alias("revenue"))


def _reviews_by_item(s, translate: bool) -> DataFrame:
    """Review scores fanned out to the items of their order (one row per item)."""
    orv = s.order_reviews.select("order_id", "review_score")
    o = s.orders.select("order_id")
    oi = lines(s).select("order_id", "product_id")
    p = s.products.select("product_id", "product_category_name")
    j = orv.join(o, "order_id").join(oi, "order_id").join(p, "product_id")
    if translate:
        t = s.translation
        j = j.join(t, "product_category_name", "left").select(
            F.coalesce("product_category_name_english", "product_category_name").alias("category"),
            "review_score")
    return j


def q05_avg_review_by_category(s) -> DataFrame:
    j = _reviews_by_item(s, translate=False)
    return (j.groupBy("product_category_name")
            .agg(exact_mean(F.sum("review_score"), F.count("review_score")).alias("avg_score"))
            .orderBy(F.col("avg_score").desc_nulls_first(),
                     F.col("product_category_name").asc_nulls_last()))


def q06_payment_type_share(s) -> DataFrame:
    counts = (s.order_payments.groupBy("payment_type")
              .agg(F.count(F.lit(1)).alias("count_payments")))
    # payment types are a small fixed domain: the total is a window over them
    return (with_share(counts, "count_payments", "percent_share", digits=2, few_groups=True)
            .orderBy(F.col("percent_share").desc_nulls_first(), "payment_type"))


def _order_totals(s) -> DataFrame:
    """Per-order SUM(price + freight) over orders ⋈ items, keyed by order.

    Items are summed below the join, so a hot order arrives there as one row."""
    o = s.orders.select("order_id", "customer_id")
    items = lines(s).groupBy("order_id").agg(F.sum(_item_total()).alias("order_total"))
    return o.join(items, "order_id")


def q07_avg_order_total_by_state(s) -> DataFrame:
    c = s.customers.select("customer_id", "customer_state")
    return (_order_totals(s).join(c, "customer_id").groupBy("customer_state")
            .agg(exact_mean(F.sum("order_total"), F.count("order_total")).alias("avg_order_total"))
            .orderBy(F.col("avg_order_total").desc_nulls_first(), "customer_state"))


def q08_top_sellers(s, k: int = 10) -> DataFrame:
    sold = lines(s).groupBy("seller_id").agg(F.count(F.lit(1)).alias("items_sold"))
    counts = sold.join(s.sellers.select("seller_id"), "seller_id")
    return top_k(counts, k, [F.col("items_sold").desc(), F.col("seller_id")])


def q09_late_delivery_percent(s) -> DataFrame:
    o = s.orders.where(not_null("order_delivered_customer_date"))
    late = late_flag("order_delivered_customer_date", "order_estimated_delivery_date")
    return (o.agg(F.count_if(late).alias("late"), F.count(F.lit(1)).alias("n"))
            .select(percent(F.col("late"), F.col("n"), 2).alias("late_delivery_percent")))


def q10_top_categories_items(s, k: int = 10) -> DataFrame:
    oi = lines(s).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    p = s.products.select("product_id", "product_category_name")
    counts = (oi.join(p, "product_id").groupBy("product_category_name")
              .agg(F.sum("n").alias("items_count")))
    return top_k(counts, k, [F.col("items_count").desc(),
                             F.col("product_category_name").asc_nulls_last()])


# ------------------------------------------------ chart and workbook reports
def q11_monthly_revenue(s) -> DataFrame:
    o = s.orders.select("order_id", "order_purchase_timestamp")
    items = lines(s).groupBy("order_id").agg(F.sum(_item_total()).alias("order_total"))
    return (o.join(items, "order_id")
            .groupBy(month_start(F.col("order_purchase_timestamp")).alias("month"))
            .agg(F.sum("order_total").cast("double").alias("monthly_revenue"))
            .orderBy("month"))


def q12_payment_fanout_counts(s) -> DataFrame:
    """COUNT(*) of payments ⋈ orders ⋈ items per payment type.

    Each payment row is repeated once per item of its order; the count is
    therefore Σ_order payments(order, type) × items(order), computed from two
    per-order aggregates so no fan-out rows are produced.
    """
    pay = (s.order_payments.groupBy("order_id", "payment_type")
           .agg(F.count(F.lit(1)).alias("n_pay")))
    items = lines(s).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    o = s.orders.select("order_id")
    return (pay.join(o, "order_id", "left_semi").join(items, "order_id")
            .groupBy("payment_type")
            .agg(F.sum(F.col("n_pay") * F.col("n_items")).alias("cnt"))
            .orderBy(F.col("cnt").desc(), "payment_type"))


def q12b_payment_fanout_share(s) -> DataFrame:
    """Pie-chart labels: q12's counts with their share, 1 decimal."""
    counts = q12_payment_fanout_counts(s)
    return with_share(counts, "cnt", "share_percent", digits=1, few_groups=True)


def _category_english(s, items: DataFrame) -> DataFrame:
    p = s.products.select("product_id", "product_category_name")
    t = s.translation
    return (items.join(p, "product_id").join(t, "product_category_name", "left")
            .withColumn("category", F.coalesce("product_category_name_english",
                                               "product_category_name")))


def q13_top_categories_english(s, k: int = 10) -> DataFrame:
    j = _category_english(s, lines(s).select("product_id", "price"))
    rev = j.groupBy("category").agg(F.sum("price").alias("rev"))
    top = top_k(rev, k, [F.col("rev").desc_nulls_first(), F.col("category").asc_nulls_last()])
    return top.select("category", F.col("rev").cast("double").alias("revenue"))


def _orders_of_years(s, years) -> DataFrame:
    """The orders that the caller's exact filter on the year can keep."""
    return orders_between(s, ts_literal(f"{min(years)}-01-01 00:00:00"), ts_literal(f"{max(years) + 1}-01-01 00:00:00"))


def q14_category_year_revenue(s, years=YEARS, k: int = 30) -> DataFrame:
    o = _orders_of_years(s, years).select("order_id", "order_purchase_timestamp")
    ts = F.col("order_purchase_timestamp")
    o = o.where(year_range(ts, min(years), max(years)) & in_list(F.year(ts), years))
    oi = lines(s).select("order_id", "product_id", "price")
    j = _category_english(s, oi.join(o, "order_id"))
    rev = (j.groupBy("category", F.year(ts).cast("int").alias("year"))
           .agg(F.sum("price").alias("rev")))
    # sorted by the unrounded sum, which is not part of the output
    top = top_k(rev, k, [F.col("rev").desc_nulls_first(),
                         F.col("category").asc_nulls_last(), F.col("year")])
    return top.select("category", "year", F.round("rev", 2).cast("double").alias("revenue"))


def q14b_category_year_top10(s, years=YEARS, k_rows: int = 30, k_groups: int = 10) -> DataFrame:
    """The q14 rows of its best categories, as a category × year grid.

    Categories are ranked by revenue summed over the top ``k_rows`` rows
    only (not over all data), then every selected category gets one row per
    year, 0 where the year is missing.  Everything after the first LIMIT
    works on at most ``k_rows`` rows.
    """
    rows = q14_category_year_revenue(s, years, k_rows)
    # like a pandas groupby, a NULL category is not a group of its own
    totals = (rows.where(F.col("category").isNotNull())
              .groupBy("category").agg(F.sum("revenue").alias("total")))
    best = top_k(totals, k_groups, [F.col("total").desc(), F.col("category").asc_nulls_last()])
    grid = best.select("category", F.explode(F.array(*[F.lit(y) for y in years])).alias("year"))
    return (grid.join(rows, ["category", "year"], "left")
            .select("category", F.col("year").cast("int").alias("year"),
                    F.coalesce("revenue", F.lit(0.0)).alias("revenue")))


def q15_review_by_category_min50(s, min_reviews: int = 50, k: int = 10) -> DataFrame:
    j = _reviews_by_item(s, translate=True).where(F.col("review_score").isNotNull())
    agg = (j.groupBy("category")
           .agg(F.sum("review_score").alias("total"), F.count(F.lit(1)).alias("n_reviews"))
           .where(F.col("n_reviews") >= min_reviews)
           .select("category", round_ratio(F.col("total"), F.col("n_reviews"), 3).alias("avg_score"),
                   "n_reviews"))
    return top_k(agg, k, [F.col("avg_score").desc_nulls_first(), F.col("n_reviews").desc(),
                          F.col("category").asc_nulls_last()])


def _per_order_with_payments(s, delivered_only: bool) -> DataFrame:
    """SUM(price + freight) of orders ⋈ items ⋈ payments, per order.

    The payment join repeats every item once per payment of its order, so the
    sum equals (Σ items) × (number of payments); both factors are per-order
    aggregates joined 1:1 on the order key.
    """
    o = s.orders
    if delivered_only:
        o = o.where(F.col("order_delivered_customer_date").isNotNull())
    items = (lines(s).groupBy("order_id")
             .agg(F.sum(_item_total()).alias("items_total")))
    pays = s.order_payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_pay"))
    return (o.join(items, "order_id").join(pays, "order_id")
            .withColumn("order_total", (F.col("items_total") * F.col("n_pay")).cast("double")))


def q16_per_order_totals(s) -> DataFrame:
    return _per_order_with_payments(s, False).select("order_id", "order_total")


def q17_delivery_vs_total(s, lo: float = 0, hi: float = 60) -> DataFrame:
    j = _per_order_with_payments(s, True)
    days = days_between(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return (j.select("order_id", days.alias("delivery_days"), "order_total")
            .where(between_filter("delivery_days", lo, hi)))


def q18_state_order_totals(s) -> DataFrame:
    c = s.customers.select("customer_id", "customer_state")
    return (_order_totals(s).join(c, "customer_id").groupBy("customer_state")
            .agg(F.sum("order_total").alias("total"), F.count(F.lit(1)).alias("n_orders"))
            .select("customer_state",
                    round_money_mean(F.col("total"), F.col("n_orders"), 2).alias("avg_order_total"),
                    "n_orders")
            .orderBy(F.col("avg_order_total").desc_nulls_first(), "customer_state"))


def q19_orders_by_month_year(s, first_year: int = YEARS[0], last_year: int = YEARS[-1]) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    o = _orders_of_years(s, (first_year, last_year)).select("order_purchase_timestamp").where(
        ts.isNotNull() & year_range(ts, first_year, last_year))
    return (o.groupBy(month_start(ts).alias("month_start"), F.year(ts).cast("int").alias("year"))
            .agg(F.count(F.lit(1)).cast("int").alias("order_count"))
            .orderBy("month_start", "year"))


def q19b_month_by_year_pivot(s, years=YEARS) -> DataFrame:
    """Month number (1..12) × year order counts, missing cells 0."""
    monthly = q19_orders_by_month_year(s, min(years), max(years))
    pivot = (monthly.groupBy(F.month("month_start").alias("month_num"))
             .pivot("year", list(years)).agg(F.sum("order_count")))
    months = s.spark.range(1, 13).select(F.col("id").cast("int").alias("month_num"))
    out = months.join(pivot, "month_num", "left")
    return out.select("month_num", *[F.coalesce(F.col(str(y)), F.lit(0)).cast("int").alias(f"y{y}")
                                     for y in years]).orderBy("month_num")


def _orders_by_state_month(s) -> DataFrame:
    o = s.orders.select("customer_id", "order_purchase_timestamp").where(
        F.col("order_purchase_timestamp").isNotNull())
    c = s.customers.select("customer_id", "customer_state").where(F.col("customer_state").isNotNull())
    return o.join(c, "customer_id").select(
        month_start(F.col("order_purchase_timestamp")).alias("month"),
        F.col("customer_state").alias("state"))


def q20_top5_state_series(s, k: int = 5) -> DataFrame:
    obs = _orders_by_state_month(s)
    # per-state totals are derived from the (month, state) aggregate, so the
    # order rows are shuffled once
    monthly = obs.groupBy("month", "state").agg(F.count(F.lit(1)).alias("n"))
    totals = monthly.groupBy("state").agg(F.sum("n").alias("cnt"))
    top = top_k(totals, k, [F.col("cnt").desc(), F.col("state")]).select("state")
    return (isin_top_k(monthly, top, "state")
            .select("month", "state", F.col("n").cast("int").alias("orders_count"))
            .orderBy("month", "state"))


def q20b_series_zero_filled(s, k: int = 5) -> DataFrame:
    series = q20_top5_state_series(s, k)
    # at most k states: the month bounds come from a window over k rows
    return (densify_months(series, "state", "month", "orders_count", few_keys=True)
            .orderBy("state", "month"))


def q20c_cumulative_frames(s, k: int = 5) -> DataFrame:
    series = q20_top5_state_series(s, k)
    return densify_with_frames(series, "state", "month", "orders_count", "frame", few_keys=True)


def q20d_axis_range(s, k: int = 5) -> DataFrame:
    """Axis range of the zero-filled series: first and last month, 1.1 × the
    largest count.  Zero-filling adds neither months outside the bounds nor
    counts above the largest one, so the series itself is aggregated."""
    series = q20_top5_state_series(s, k)
    return series.agg(F.min("month").alias("x_min"), F.max("month").alias("x_max"),
                      (F.max("orders_count").cast("double") * F.lit(1.1)).alias("y_max"))


# ---------------------------------------------------- basic table lookups
def q21_customers_head(s, n: int = 10) -> DataFrame:
    """The first ``n`` customers by id (the reference's LIMIT has no order)."""
    return top_k(s.customers, n, ["customer_id"])


def q22_geo_city_prefix(s, prefix: str = "nation_1") -> DataFrame:
    g = s.geolocation.where(like_prefix("geolocation_city", prefix))
    # coordinates leave the report as DOUBLE like every other measure
    return g.select("geolocation_zip_code_prefix",
                    F.col("geolocation_lat").cast("double").alias("geolocation_lat"),
                    F.col("geolocation_lng").cast("double").alias("geolocation_lng"),
                    "geolocation_city", "geolocation_state").orderBy("geolocation_zip_code_prefix")


def q23_customers_by_zip(s, zip_prefix: int = 1042) -> DataFrame:
    return s.customers.where(eq_filter("customer_zip_code_prefix", zip_prefix))


def q24_geo_state_customer_pairs(s) -> DataFrame:
    """COUNT(*) of geolocation ⋈ customers on ZIP, per geolocation state.

    The join is many-to-many; the pair count per (state, zip) is the product
    of the two per-ZIP counts, so a hot ZIP costs one row, not its square.
    """
    g = (s.geolocation.groupBy("geolocation_state", "geolocation_zip_code_prefix")
         .agg(F.count(F.lit(1)).alias("n_geo")))
    c = (s.customers.groupBy("customer_zip_code_prefix")
         .agg(F.count(F.lit(1)).alias("n_cust")))
    j = g.join(c, g.geolocation_zip_code_prefix == c.customer_zip_code_prefix)
    return (j.groupBy("geolocation_state").agg(F.sum(F.col("n_geo") * F.col("n_cust")).alias("n"))
            .orderBy(F.col("n").desc(), "geolocation_state"))


# ------------------------------------------------- load-generator read set
def q25_table_counts(s) -> DataFrame:
    parts = [s.table(name).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name in ("customers", "products", "orders", "sellers")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q26_avg_item_price(s) -> DataFrame:
    oi = lines(s)
    return oi.agg(exact_mean(F.sum("price"), F.count("price")).alias("avg_price"))


def q27_sum_payments(s) -> DataFrame:
    return s.order_payments.agg(F.sum("payment_value").cast("double").alias("sum_payment_value"))


def _count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def q28a_customers_by_state(s) -> DataFrame:
    return _count_by(s.customers, "customer_state")


def q28b_products_by_category(s) -> DataFrame:
    return _count_by(s.products, "product_category_name")


def q28c_orders_by_status(s) -> DataFrame:
    return _count_by(s.orders, "order_status")


def q28d_sellers_by_state(s) -> DataFrame:
    return _count_by(s.sellers, "seller_state")


def q28e_payments_by_type(s) -> DataFrame:
    return _count_by(s.order_payments, "payment_type")


def q29_orders_by_customer_state(s) -> DataFrame:
    c = s.customers.select("customer_id", "customer_state")
    o = s.orders.select("order_id", "customer_id")
    return (c.join(o, "customer_id", "left").groupBy("customer_state")
            .agg(F.count_distinct("order_id").alias("order_count"))
            .orderBy(F.col("order_count").desc(), "customer_state"))


def q30_avg_price_by_category(s) -> DataFrame:
    p = s.products.select("product_id", "product_category_name")
    oi = lines(s).select("product_id", "price")
    return (p.join(oi, "product_id").groupBy("product_category_name")
            .agg(exact_mean(F.sum("price"), F.count("price")).alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_first(),
                     F.col("product_category_name").asc_nulls_last()))


def q31_orders_by_seller_state(s) -> DataFrame:
    se = s.sellers.select("seller_id", "seller_state")
    oi = lines(s).select("seller_id", "order_id")
    return (se.join(oi, "seller_id").groupBy("seller_state")
            .agg(F.count_distinct("order_id").alias("orders_count"))
            .orderBy(F.col("orders_count").desc(), "seller_state"))


def q32_orders_by_hour(s) -> DataFrame:
    return (s.orders.groupBy(F.hour("order_purchase_timestamp").cast("int").alias("hour"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy(F.col("hour").asc_nulls_last()))


def q33_avg_payment_by_type(s) -> DataFrame:
    return (s.order_payments.groupBy("payment_type")
            .agg(exact_mean(F.sum("payment_value"), F.count("payment_value")).alias("avg_payment"))
            .orderBy(F.col("avg_payment").desc_nulls_first(), "payment_type"))


def q34_states_with_orders(s) -> DataFrame:
    c = s.customers.select("customer_id", "customer_state")
    o = s.orders.select("order_id", "customer_id")
    return (c.join(o, "customer_id", "left").groupBy("customer_state")
            .agg(F.count("order_id").alias("avg_orders"))
            .where(range_cmp("avg_orders", ">", 0))
            .orderBy(F.col("avg_orders").desc(), "customer_state"))


def q35_top3_price_rank(s, k: int = 3) -> DataFrame:
    p = s.products.select("product_id", "product_category_name")
    oi = lines(s).select("product_id", "price")
    w = Window.partitionBy("product_category_name").orderBy(F.col("price").desc_nulls_first())
    ranked = p.join(oi, "product_id").withColumn("price_rank", F.rank().over(w))
    return ranked.where(F.col("price_rank") <= k).select(
        "product_category_name", F.col("price_rank").cast("int").alias("price_rank"))


def q36_recent_daily_orders(s, as_of: str = AS_OF, days: int = 30) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    since = relative_time(as_of, days=days)
    return (orders_between(s, since).where(ts > since)
            .groupBy(F.to_date(ts).alias("order_date"))
            .agg(F.count(F.lit(1)).alias("daily_orders"))
            .orderBy(F.col("order_date").desc()))


_LOOKUP_COLS = ["order_id", "order_status", "order_purchase_timestamp",
                "order_delivered_customer_date", "customer_id", "customer_unique_id",
                "customer_city", "customer_state"]


def q37_orders_by_customer(s, customer_id: str = "1000") -> DataFrame:
    o = s.orders.where(F.col("customer_id") == F.lit(customer_id))
    c = s.customers.where(F.col("customer_id") == F.lit(customer_id))
    return (o.join(c, "customer_id").select(*_LOOKUP_COLS)
            .orderBy(F.col("order_purchase_timestamp").desc_nulls_last(), "order_id"))


def q38_orders_by_city(s, city: str = "nation_1 building", exact: bool = False) -> DataFrame:
    """Orders of customers in a city, case-insensitive.  As in the reference,
    ``%`` and ``_`` in ``city`` are wildcards (ILIKE); ``exact=True`` compares
    the lower-cased strings instead."""
    c = s.customers.where(ilike_match("customer_city", city, exact))
    o = s.orders
    return (o.join(c, "customer_id").select(*_LOOKUP_COLS)
            .orderBy(F.col("order_purchase_timestamp").desc_nulls_last(), "order_id"))


def q39_last_order_day(s, id_prefix: str | None = None,
                       fallback: str = "2016-09-01") -> DataFrame:
    o = s.orders
    if id_prefix is not None:
        o = o.where(like_prefix("order_id", id_prefix))
    return o.agg(F.coalesce(F.max(F.to_date("order_purchase_timestamp")),
                            F.lit(fallback).cast("date")).alias("last_day"))


def q40_last_day_and_count(s, id_prefix: str = "12", start: str = "1998-01-01") -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    start_d = F.lit(start).cast("date")
    since = start_d.cast("timestamp_ntz")
    o = orders_between(s, since).where(like_prefix("order_id", id_prefix) & range_cmp(ts, ">=", since))
    per_day = o.groupBy(F.to_date(ts).alias("d")).agg(F.count(F.lit(1)).alias("cnt"))
    last = per_day.agg(F.max("d").alias("d"), F.max_by("cnt", "d").alias("cnt"))
    return last.select(F.coalesce("d", F.date_sub(start_d, 1)).alias("last_day"),
                       F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"))


REPORTS = {
    "q01_monthly_items_revenue": q01_monthly_items_revenue,
    "q02_avg_delivery_time": q02_avg_delivery_time,
    "q03_top_cities": q03_top_cities,
    "q04_top_categories_revenue": q04_top_categories_revenue,
    "q05_avg_review_by_category": q05_avg_review_by_category,
    "q06_payment_type_share": q06_payment_type_share,
    "q07_avg_order_total_by_state": q07_avg_order_total_by_state,
    "q08_top_sellers": q08_top_sellers,
    "q09_late_delivery_percent": q09_late_delivery_percent,
    "q10_top_categories_items": q10_top_categories_items,
    "q11_monthly_revenue": q11_monthly_revenue,
    "q12_payment_fanout_counts": q12_payment_fanout_counts,
    "q12b_payment_fanout_share": q12b_payment_fanout_share,
    "q13_top_categories_english": q13_top_categories_english,
    "q14_category_year_revenue": q14_category_year_revenue,
    "q14b_category_year_top10": q14b_category_year_top10,
    "q15_review_by_category_min50": q15_review_by_category_min50,
    "q16_per_order_totals": q16_per_order_totals,
    "q17_delivery_vs_total": q17_delivery_vs_total,
    "q18_state_order_totals": q18_state_order_totals,
    "q19_orders_by_month_year": q19_orders_by_month_year,
    "q19b_month_by_year_pivot": q19b_month_by_year_pivot,
    "q20_top5_state_series": q20_top5_state_series,
    "q20b_series_zero_filled": q20b_series_zero_filled,
    "q20c_cumulative_frames": q20c_cumulative_frames,
    "q20d_axis_range": q20d_axis_range,
    "q21_customers_head": q21_customers_head,
    "q22_geo_city_prefix": q22_geo_city_prefix,
    "q23_customers_by_zip": q23_customers_by_zip,
    "q24_geo_state_customer_pairs": q24_geo_state_customer_pairs,
    "q25_table_counts": q25_table_counts,
    "q26_avg_item_price": q26_avg_item_price,
    "q27_sum_payments": q27_sum_payments,
    "q28a_customers_by_state": q28a_customers_by_state,
    "q28b_products_by_category": q28b_products_by_category,
    "q28c_orders_by_status": q28c_orders_by_status,
    "q28d_sellers_by_state": q28d_sellers_by_state,
    "q28e_payments_by_type": q28e_payments_by_type,
    "q29_orders_by_customer_state": q29_orders_by_customer_state,
    "q30_avg_price_by_category": q30_avg_price_by_category,
    "q31_orders_by_seller_state": q31_orders_by_seller_state,
    "q32_orders_by_hour": q32_orders_by_hour,
    "q33_avg_payment_by_type": q33_avg_payment_by_type,
    "q34_states_with_orders": q34_states_with_orders,
    "q35_top3_price_rank": q35_top3_price_rank,
    "q36_recent_daily_orders": q36_recent_daily_orders,
    "q37_orders_by_customer": q37_orders_by_customer,
    "q38_orders_by_city": q38_orders_by_city,
    "q39_last_order_day": q39_last_order_day,
    "q39b_last_order_day_by_prefix": lambda s: q39_last_order_day(s, id_prefix="12"),
    "q40_last_day_and_count": q40_last_day_and_count,
}
