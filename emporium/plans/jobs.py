"""Registered table jobs beyond the reports, each over the logical tables of
a ``Star``: loading (insert-if-absent, distinct load, CSV bulk load with
publish), the workbook export, DML versions, quality checks, the column
profile, metric tables (incl. the exposition-format round trip), streaming
ingest / dedupe / daily counts / gauges, and the point-cloud steps.  Jobs
that write (exports, streams, checkpoints) use fresh folders under
``spark.checkpoint.dir``.

Jobs that produce a new table version return that whole version; money
columns leave these checkable views as DOUBLE (the library functions
themselves keep DECIMAL).  Parameters that the reference hard-coded are
re-based on the test data (``AS_OF`` and id prefixes of numeric ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from emporium.operators import dml, metrics, points, quality, upsert
from emporium.operators.profile import column_profile
from emporium.plans.reports import AS_OF, q06_payment_type_share

ITEM_KEY = ["order_id", "order_item_id"]
# the raw batch has no file order; this is the explicit "first row" order
ITEM_ORDER = ["shipping_limit_date", "product_id", "seller_id", "price", "freight_value"]
# Test-data stand-ins for the reference's city renames (its cities do not occur here).
TEST_CITY_RENAMES = {"NATION_1 BUILDING": "Nation 1 Building",
                     "NATION_2 MACHINERY": "Nation 2 Machinery"}


def checkable(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, everything else unchanged."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


# ------------------------------------------------------------------- loading
def load_insert_if_absent_items(s) -> DataFrame:
    """Raw line items (repeating keys) inserted into order_items: first row
    per key wins, keys already stored are skipped."""
    ch = upsert.insert_if_absent(s.order_items, s.order_items_raw, ITEM_KEY, order_by=ITEM_ORDER)
    return checkable(ch.table)


def load_insert_if_absent_twice(s) -> DataFrame:
    """The same batch loaded twice: equal to loading it once (idempotence)."""
    once = upsert.insert_if_absent(s.order_items, s.order_items_raw, ITEM_KEY, order_by=ITEM_ORDER)
    twice = upsert.insert_if_absent(once.table, s.order_items_raw, ITEM_KEY, order_by=ITEM_ORDER)
    return checkable(twice.table)


def load_geolocation_distinct(s) -> DataFrame:
    """Geolocation rows loaded into an empty table with a unique index on all columns."""
    raw = s.geolocation_raw
    ch = upsert.insert_distinct_if_absent(raw.limit(0), raw)
    return checkable(ch.table)


def load_bulk_from_csv(s) -> DataFrame:
    """The nine tables written as CSV by Spark (geolocation with its duplicate
    rows), bulk-loaded back with COPY rules, key checks and one publish;
    returns the published row count per table."""
    from emporium.plans.load import LOAD_ORDER, bulk_load, export_csv
    from emporium.session import scratch_path
    run = scratch_path(s.spark, "bulk-load")
    tables = {name: s.table("geolocation_raw" if name == "geolocation" else name)
              for name in LOAD_ORDER}
    result = bulk_load(s.spark, export_csv(tables, f"{run}/csv"), f"{run}/warehouse")
    counts = [result.tables[name].agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count") for name in LOAD_ORDER]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# The chart datasets of the reference's workbook, one sheet each.
WORKBOOK = {
    "monthly_revenue": "q11_monthly_revenue",
    "payment_share": "q12b_payment_fanout_share",
    "category_year": "q14b_category_year_top10",
    "review_scores": "q15_review_by_category_min50",
    "orders_by_month": "q19b_month_by_year_pivot",
    "delivery_vs_total": "q17_delivery_vs_total",
}


def report_workbook(s) -> DataFrame:
    """Write the workbook sheets (Parquet, one folder per sheet) and return
    the rows written per sheet."""
    from emporium.operators.sinks import write_sheets
    from emporium.plans.reports import REPORTS
    from emporium.session import scratch_path
    sheets = {sheet: REPORTS[q](s) for sheet, q in WORKBOOK.items()}
    counts = write_sheets(sheets, scratch_path(s.spark, "workbook"))
    return s.spark.createDataFrame(sorted(counts.items()), "sheet string, row_count long")


# ----------------------------------------------------------------------- DML
def dml_u1_mark_delivered(s) -> DataFrame:
    return dml.u1_mark_delivered(s.orders, AS_OF).table


def dml_u2_products(s) -> DataFrame:
    return dml.u2_products(s.products, id_prefix="1").table


def dml_u3_price_jitter(s) -> DataFrame:
    return checkable(dml.u3_price_jitter(s.order_items, s.orders, AS_OF).table)


def dml_u4_city_rename(s) -> DataFrame:
    return dml.u4_city_rename(s.customers, id_prefix="1", renames=TEST_CITY_RENAMES).table


def dml_u5_installments(s) -> DataFrame:
    return checkable(dml.u5_installments(s.order_payments).table)


def dml_delete_stale_orders(s) -> DataFrame:
    """The reference's maintenance DELETE: the oldest 15 stale orders with the
    id prefix.  They have items, so the foreign keys make the statement fail
    and it is rolled back: the table is unchanged."""
    children = [(s.order_items, "order_id"), (s.order_payments, "order_id"),
                (s.order_reviews, "order_id")]
    return dml.delete_stale_orders(s.orders, AS_OF, id_prefix="12", children=children,
                                   on_child="rollback").table


FOREIGN_KEYS = [dml.ForeignKey(child, "order_id", "orders", "order_id")
                for child in ("order_items", "order_payments", "order_reviews")]


def dml_delete_orders_cascade(s) -> DataFrame:
    """The oldest stale orders with the id prefix, deleted with their items,
    payments and reviews and published as one version of four tables; returns
    the keys of all rows left."""
    from emporium.operators.sinks import publish_tables, read_published
    from emporium.session import scratch_path
    stale = dml.delete_stale_orders(s.orders, AS_OF, id_prefix="12", k=150, on_child="ignore").changed
    tables = {n: s.table(n) for n in ("orders", "order_items", "order_payments", "order_reviews")}
    changes = dml.delete_cascade(tables, "orders", stale, FOREIGN_KEYS)
    root = scratch_path(s.spark, "cascade")
    publish_tables(s.spark, {n: c.table for n, c in changes.items()}, root)
    part = {"orders": "null", "order_items": "order_item_id", "order_payments": "payment_sequential",
            "order_reviews": "review_id"}
    out = None
    for name, table in read_published(s.spark, root).items():
        keys = table.selectExpr(f"'{name}' as table_name", "order_id", f"cast({part[name]} as string) as part")
        out = keys if out is None else out.unionByName(keys)
    return out


def dml_city_rename_all(s) -> DataFrame:
    """The city rename over all customers of the prefix instead of eight of them."""
    return dml.u4_city_rename(s.customers, id_prefix="1", renames=TEST_CITY_RENAMES, k=1_000_000).changed


# ------------------------------------------------------------------- quality
def quality_duplicate_item_keys(s) -> DataFrame:
    return quality.check_unique(s.order_items_raw, ITEM_KEY)


def quality_orphan_items(s) -> DataFrame:
    return checkable(quality.check_foreign_key(s.order_items, "product_id", s.products, "product_id"))


def quality_orphans_of_recall(s) -> DataFrame:
    """Items whose product is not among the products left after a recall."""
    left = s.products.where("cast(product_id as int) % 10 != 3")
    return checkable(quality.check_foreign_key(s.order_items, "product_id", left, "product_id"))


def _requests(s) -> dict:
    """Insert requests with gaps: states as two-letter codes or blank, some
    missing values, some negative numbers."""
    n = "cast({} as int)"
    customers = s.customers.selectExpr(
        "customer_id", f"if({n.format('customer_id')} % 3 = 0, '', customer_unique_id) as customer_unique_id",
        f"if({n.format('customer_id')} % 7 = 0, -1, customer_zip_code_prefix) as customer_zip_code_prefix",
        f"if({n.format('customer_id')} % 5 = 0, null, customer_city) as customer_city",
        f"case {n.format('customer_id')} % 4 when 0 then concat(' ', left(customer_state, 2), ' ') "
        "when 1 then '  ' when 2 then null else customer_state end as customer_state")
    sellers = s.sellers.selectExpr(
        "seller_id", f"if({n.format('seller_id')} % 7 = 0, -5, seller_zip_code_prefix) as seller_zip_code_prefix",
        f"if({n.format('seller_id')} % 5 = 0, null, seller_city) as seller_city",
        f"if({n.format('seller_id')} % 2 = 0, right(seller_state, 3), seller_state) as seller_state")
    orders = s.orders_placed.selectExpr("order_id", "customer_id", f"if({n.format('order_id')} % 2 = 0, null, "
                                        "order_status) as order_status")
    return {"customers": customers, "sellers": sellers, "orders": orders}


def quality_accepted_customers(s) -> DataFrame:
    return quality.validate_rows(
        _requests(s)["customers"], quality.CUSTOMER_DEFAULTS, int_ge0=["customer_zip_code_prefix"],
        state_col="customer_state", unique_from=("customer_unique_id", "customer_id"))[0]


def quality_accepted_sellers(s) -> DataFrame:
    return quality.validate_rows(_requests(s)["sellers"], quality.SELLER_DEFAULTS,
                                 int_ge0=["seller_zip_code_prefix"], state_col="seller_state")[0]


def quality_accepted_orders(s) -> DataFrame:
    return quality.validate_rows(_requests(s)["orders"], quality.ORDER_DEFAULTS)[0]


def quality_rejected_customers(s) -> DataFrame:
    _, rejected = quality.validate_rows(
        s.customers, quality.CUSTOMER_DEFAULTS, int_ge0=["customer_zip_code_prefix"],
        state_col="customer_state", unique_from=("customer_unique_id", "customer_id"))
    return rejected


def catalog_rows_total(s) -> DataFrame:
    """Exact total row count over the nine logical tables (order items are
    counted from their line view: the item number does not change the count)."""
    from emporium.plans.reports import lines
    tables = {name: s.table(name) for name in s.LOGICAL if name != "order_items"}
    tables["order_items"] = lines(s)
    return quality.rows_total(tables)


def profile_products(s) -> DataFrame:
    return column_profile(s.products)


# ------------------------------------------------------------------- metrics
def _flat(samples: DataFrame) -> DataFrame:
    return samples.select("*", F.col("labels")["city"].alias("city")).drop("labels")


def metrics_latest_gauges(s) -> DataFrame:
    return _flat(metrics.latest_gauges(s.metric_samples))


def metrics_weather_gauges(s) -> DataFrame:
    """Weather responses as JSON lines, one per event, with missing fields,
    failed fetches and bodies cut short; the last good gauges per city."""
    from emporium.session import scratch_path
    from emporium.sources.files import read_weather_json
    path = scratch_path(s.spark, "weather")
    body = ("concat('{\"main\":{\"temp\":', value, if(event_id % 4 = 0, '', concat(',\"humidity\":', event_id % 100)), "
            "'},\"wind\":{\"speed\":', event_id % 30, if(event_id % 11 = 0, '', '}}'))")
    s.raw("events").selectExpr(
        "concat('city_', user_id % 4) as city", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") as ts",
        "event_type != 'error' as ok", f"{body} as body").write.json(path)
    samples = metrics.weather_to_metrics(read_weather_json(s.spark, path))
    latest = _flat(metrics.latest_gauges(samples))
    return latest.select("metric", "city", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


def metrics_api_health_hourly(s) -> DataFrame:
    samples = s.metric_samples.withColumn("round", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return metrics.api_health(samples, "round")


def metrics_resample_last_15m(s) -> DataFrame:
    return _flat(metrics.resample_last(s.metric_samples, "15 minutes"))


def metrics_payment_share_samples(s) -> DataFrame:
    m = metrics.query_to_metrics(q06_payment_type_share(s), ["payment_type"],
                                 ["count_payments", "percent_share"], prefix="payments_")
    return m.select("metric", F.col("labels")["payment_type"].alias("payment_type"), "value")


def metrics_exposition_roundtrip(s) -> DataFrame:
    """Latest gauges written in the text exposition format (HELP/TYPE lines,
    labels) and parsed back: the values survive the round trip."""
    from emporium.operators.sinks import write_exposition
    from emporium.session import scratch_path
    from emporium.sources.files import read_exposition
    path = scratch_path(s.spark, "exposition")
    latest = metrics.latest_gauges(s.metric_samples).drop("ts")
    write_exposition(latest, path, {"click": "clicks per city"})
    back = read_exposition(s.spark, path)
    return back.select("metric", F.col("labels")["city"].alias("city"), "value")


def metrics_relabel_instance(s) -> DataFrame:
    r = metrics.relabel(s.metric_samples, "city", "instance", "external_apis")
    return r.select("metric", F.col("labels")["city"].alias("city"),
                    F.col("labels")["instance"].alias("instance"), "ts", "value")


# ----------------------------------------------------------------- streaming
#: Parts that the streamed tables arrive in.
ARRIVALS = 3


class _Arrivals:
    """A streaming star over the given raw tables, cut into parts that arrive one
    after the other: ``parts`` maps a table to the expression that deals its rows
    to arrivals 0, 1 and 2, and optionally what arrives a second time.  A part may
    be any number of files; the stream takes it whole, in one micro-batch, so how
    many micro-batches run depends neither on the rows nor on the cores."""

    def __init__(self, s, parts: dict):
        from emporium.session import scratch_path
        from emporium.sources.testdata import Star
        self.source, self.parts = s, parts
        self.folder = scratch_path(s.spark, "arrivals")
        self._deliver(0)  # a file stream needs its folder
        self.star = Star(s.spark, self.folder, streaming=True)

    def _deliver(self, k: int) -> None:
        for table, (deal, again) in self.parts.items():
            raw = self.source.raw(table)
            rows = raw.where(f"{deal} = {k}")
            if again and k:
                rows = rows.unionByName(raw.where(f"{deal} = {k - 1}").selectExpr(*again(raw.columns)))
            rows.write.mode("append").parquet(f"{self.folder}/{table}.parquet")

    def run(self, start) -> None:
        """Run the query that ``start`` starts after each arrival; its checkpoint
        tells it which files are new."""
        for k in range(ARRIVALS):
            if k:
                self._deliver(k)
            start().awaitTermination()


#: Buckets of the registered jobs' stores: few, for tables of a few megabytes.
STORE_BUCKETS = 8


def _store(s, name: str, tables: dict):
    from emporium.streaming.epochs import EpochStore
    from emporium.streaming.ingest import scratch_dirs
    out, checkpoint = scratch_dirs(s.spark, name)
    return EpochStore(s.spark, out, tables, buckets=STORE_BUCKETS), checkpoint


def _replaced(**expressions: str):
    """Select list with some columns replaced (rows that arrive a second time, changed)."""
    return lambda columns: [f"{expressions[c]} AS {c}" if c in expressions else c for c in columns]


def _ingested(s, name: str) -> DataFrame:
    """Orders, line items and payments arriving as three streams, inserted if
    absent into three tables, each micro-batch in one commit.  Two thirds of the
    orders arrive again in the next batch, changed, and are ignored; so do their
    payments; line items meet the order items stored before."""
    from emporium.streaming import ingest as st
    from emporium.streaming.epochs import Table
    resent = _replaced(o_orderstatus="'P'", o_totalprice="o_totalprice + 1", o_orderpriority="'5-LOW'")
    arrivals = _Arrivals(s, {"orders": ("o_orderkey % 3", resent), "lineitem": ("l_orderkey % 3", None)})
    streams = {"orders": arrivals.star.orders_placed, "order_items": arrivals.star.order_items_raw,
               "order_payments": arrivals.star.order_payments}
    store, checkpoint = _store(s, "ingest", {
        "orders": Table(streams["orders"].schema, ["order_id"]),
        "order_items": Table(streams["order_items"].schema, ITEM_KEY, ITEM_ORDER),
        "order_payments": Table(streams["order_payments"].schema, ["order_id", "payment_sequential"])})
    store.commit("seed", 0, {"order_items": s.order_items})
    arrivals.run(lambda: st.ingest_tables(streams, store, checkpoint))
    return checkable(store.read(name))


def stream_ingest_orders(s) -> DataFrame:
    return _ingested(s, "orders")


def stream_ingest_items(s) -> DataFrame:
    """Raw line items arriving as a stream, inserted if absent into order_items."""
    return _ingested(s, "order_items")


def stream_ingest_payments(s) -> DataFrame:
    return _ingested(s, "order_payments")


def stream_daily_counts(s) -> DataFrame:
    """Orders per purchase day from a stream whose days arrive out of order."""
    from emporium.streaming import ingest as st
    arrivals = _Arrivals(s, {"orders": ("o_orderkey % 3", None)})
    store, checkpoint = _store(s, "daily-counts", {"days": st.day_counts("day date, n long")})
    arrivals.run(lambda: st.count_days(arrivals.star.orders_placed, "order_purchase_timestamp", store, "days",
                                       checkpoint))
    return store.read("days")


def stream_dedupe_items(s) -> DataFrame:
    """Raw line items as a stream, repeated (order, line) keys dropped: the first
    to arrive stays, in a batch the first by ``ITEM_ORDER``."""
    from emporium.streaming import ingest as st
    from emporium.streaming.epochs import Table
    arrivals = _Arrivals(s, {"lineitem": ("l_suppkey % 3", None)})
    stream = arrivals.star.order_items_raw
    store, checkpoint = _store(s, "dedupe-items", {"items": Table(stream.schema, ITEM_KEY, ITEM_ORDER)})
    arrivals.run(lambda: st.ingest_tables({"items": stream}, store, checkpoint))
    return checkable(store.read("items"))


def stream_latest_gauges(s) -> DataFrame:
    """Latest successful value per series, upserted in update mode."""
    from emporium.streaming import ingest as st
    arrivals = _Arrivals(s, {"events": ("event_id % 3", None)})
    store, checkpoint = _store(s, "latest-gauges", {"latest": st.latest_values(
        "metric string, labels map<string,string>, ts timestamp_ntz, value double")})
    arrivals.run(lambda: st.upsert_latest(arrivals.star.metric_samples, store, "latest", checkpoint))
    return _flat(store.read("latest"))


# -------------------------------------------------------------------- points
def _clipped(s) -> DataFrame:
    p = s.points
    return points.points_clip(p, points.points_plane(points.points_scaled_crop(p)))


JOBS = {
    "load_insert_if_absent_items": load_insert_if_absent_items,
    "load_insert_if_absent_twice": load_insert_if_absent_twice,
    "load_geolocation_distinct": load_geolocation_distinct,
    "load_bulk_from_csv": load_bulk_from_csv,
    "report_workbook": report_workbook,
    "dml_u1_mark_delivered": dml_u1_mark_delivered,
    "dml_u2_products": dml_u2_products,
    "dml_u3_price_jitter": dml_u3_price_jitter,
    "dml_u4_city_rename": dml_u4_city_rename,
    "dml_u5_installments": dml_u5_installments,
    "dml_delete_stale_orders": dml_delete_stale_orders,
    "dml_delete_orders_cascade": dml_delete_orders_cascade,
    "dml_city_rename_all": dml_city_rename_all,
    "quality_orphans_of_recall": quality_orphans_of_recall,
    "quality_accepted_customers": quality_accepted_customers,
    "quality_accepted_sellers": quality_accepted_sellers,
    "quality_accepted_orders": quality_accepted_orders,
    "metrics_weather_gauges": metrics_weather_gauges,
    "points_crop_lower_half": lambda s: points.points_crop(s.points, 0.5),
    "points_inner_box": lambda s: points.points_scaled_crop(s.points, 0.6),
    "quality_duplicate_item_keys": quality_duplicate_item_keys,
    "quality_orphan_items": quality_orphan_items,
    "quality_rejected_customers": quality_rejected_customers,
    "catalog_rows_total": catalog_rows_total,
    "profile_products": profile_products,
    "metrics_latest_gauges": metrics_latest_gauges,
    "metrics_api_health_hourly": metrics_api_health_hourly,
    "metrics_resample_last_15m": metrics_resample_last_15m,
    "metrics_payment_share_samples": metrics_payment_share_samples,
    "metrics_relabel_instance": metrics_relabel_instance,
    "metrics_exposition_roundtrip": metrics_exposition_roundtrip,
    "stream_ingest_orders": stream_ingest_orders,
    "stream_ingest_items": stream_ingest_items,
    "stream_ingest_payments": stream_ingest_payments,
    "stream_daily_counts": stream_daily_counts,
    "stream_dedupe_items": stream_dedupe_items,
    "stream_latest_gauges": stream_latest_gauges,
    "points_bbox": lambda s: points.points_bbox(s.points),
    "points_crop": lambda s: points.points_crop(s.points, 1.0),
    "points_scaled_crop": lambda s: points.points_scaled_crop(s.points),
    "points_voxels": lambda s: points.points_voxels(s.points),
    "points_plane": lambda s: points.points_plane(points.points_scaled_crop(s.points)),
    "points_clip": _clipped,
    "points_color_by_height": lambda s: points.points_color_by_height(_clipped(s)),
    "points_extremes": lambda s: points.points_extremes(_clipped(s)),
}
