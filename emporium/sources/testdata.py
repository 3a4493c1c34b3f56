"""Logical marketplace tables over the given TPC-H-like Parquet tables.

The reference works on nine tables (customers, geolocation, orders,
order_items, order_payments, order_reviews, products, sellers and the
category translation).  Here they are derived, with Spark, from the raw
tables in a test-data folder, following the mapping fixed in FIXTURES.md §B.
Each logical table is a lazy DataFrame: a report that only touches two of
them only scans the raw files behind those two, and Catalyst prunes the
columns it does not use (e.g. ``orders`` only joins the line-item
aggregate when a delivery date is actually read).

Every derivation is a projection, a filter, a join against the small
``nation`` dimension (25 rows in every scale factor, broadcast by size), one per-order
aggregate or the per-order item numbering; none of them moves more than
the raw columns it reads.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
              "lineitem", "events", "documents", "embeddings", "pages",
              "benchmark", "labels", "conversations")

# Fixed values of the mapping (FIXTURES.md §B): order status by TPC-H status
# letter and payment type by the first character of the order priority.
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE = {"1": "credit_card", "2": "boleto", "3": "voucher",
                "4": "debit_card"}
PAYMENT_TYPE_OTHER = "not_defined"


_SCHEMAS: dict = {}


def _schema_of(spark: SparkSession, path: str):
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return _SCHEMAS[key]


def _case_sql(column: str, mapping: dict, other: str | None) -> str:
    """``CASE column WHEN 'k' THEN 'v' ... ELSE other END`` as SQL text."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    default = "NULL" if other is None else f"'{other}'"
    return f"CASE {column} {whens} ELSE {default} END"


class Star:
    """The nine logical tables plus the re-aimed metric and point tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, streaming: bool = False,
                 max_files_per_trigger: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.streaming = streaming
        self.max_files_per_trigger = max_files_per_trigger

    def raw(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_raw", {})
        if name not in cache:
            cache[name] = self._read(name)
        return cache[name]

    def _read(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if not self.streaming:
            # the footer is read once per session and path; later reads pass
            # the schema and only list the files
            return self.spark.read.schema(_schema_of(self.spark, path)).parquet(path)
        # the same row-wise derivations applied to a file stream of the raw
        # table; the schema is fixed up front, as streaming sources require
        # (a table may be one file or a folder of files: the pattern names either)
        reader = self.spark.readStream.schema(_schema_of(self.spark, path))
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.parquet(f"{self.sf_dir}/{name}.parque[t]")

    # Each view is one join/filter plus one ``selectExpr`` projection: the
    # expressions are SQL text, so building a view costs a couple of calls
    # into the JVM instead of one per sub-expression.

    # ------------------------------------------------------------ dimensions
    @cached_property
    def _nation(self) -> DataFrame:
        # a 25-row dimension at every scale factor: the planner broadcasts it
        # from its measured file size
        return self.raw("nation").select("n_nationkey", "n_name")

    def _with_nation(self, table: str, key: str) -> DataFrame:
        t = self.raw(table)
        return t.join(self._nation, t[key] == self._nation.n_nationkey)

    @cached_property
    def customers(self) -> DataFrame:
        return self._with_nation("customer", "c_nationkey").selectExpr(
            "cast(c_custkey as string) as customer_id",
            "c_name as customer_unique_id",
            "cast(1000 + c_custkey % 500 as int) as customer_zip_code_prefix",
            "concat(n_name, ' ', c_mktsegment) as customer_city",
            "n_name as customer_state")

    @cached_property
    def geolocation_raw(self) -> DataFrame:
        """Geolocation rows as delivered (with exact duplicates)."""
        return self._with_nation("customer", "c_nationkey").selectExpr(
            "cast(1000 + c_custkey % 500 as int) as geolocation_zip_code_prefix",
            "cast(c_nationkey - 12 as decimal(10,6)) as geolocation_lat",
            "cast(c_nationkey * 2 - 25 as decimal(10,6)) as geolocation_lng",
            "lower(n_name) as geolocation_city",
            "n_name as geolocation_state")

    @cached_property
    def geolocation(self) -> DataFrame:
        """Geolocation as loaded: unique on all five columns (DISTINCT)."""
        return self.geolocation_raw.distinct()

    @cached_property
    def sellers(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").selectExpr(
            "cast(s_suppkey as string) as seller_id",
            "cast(1000 + s_suppkey % 500 as int) as seller_zip_code_prefix",
            "lower(n_name) as seller_city",
            "n_name as seller_state")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "case when p_partkey % 50 != 0 then p_brand end as product_category_name",
            "cast(length(p_name) as int) as product_name_lenght",
            "cast(p_size * 10 as int) as product_description_lenght",
            "cast(1 + p_partkey % 5 as int) as product_photos_qty",
            "cast(p_size * 100 as int) as product_weight_g",
            "cast(p_size as int) as product_length_cm",
            "cast(p_size as int) as product_height_cm",
            "cast(p_size as int) as product_width_cm")

    @cached_property
    def translation(self) -> DataFrame:
        brands = self.raw("part").select("p_brand").where("p_brand not like '%7'").distinct()
        return brands.selectExpr(
            "p_brand as product_category_name",
            "lower(replace(p_brand, '#', '_')) as product_category_name_english")

    # ----------------------------------------------------------------- facts
    @cached_property
    def orders(self) -> DataFrame:
        return self._orders_view(self.raw("orders"))

    def orders_between(self, since: Column | None = None, until: Column | None = None) -> DataFrame:
        """``orders``, of which rows placed before ``since`` or from ``until`` on may be missing.

        The caller's exact filter on the purchase time cannot reach the scan, as
        the time is derived: it lies 0 to 23 hours after the stored date.  These
        are the bounds that follow for the stored date, which Parquet can skip by.
        """
        o = self.raw("orders")
        if since is not None:
            o = o.where(F.col("o_orderdate") >= since - F.expr("interval 23 hours"))
        if until is not None:
            o = o.where(F.col("o_orderdate") < until)
        return self._orders_view(o)

    def _orders_view(self, o: DataFrame) -> DataFrame:
        # last ship date per order: a partial (map-side) aggregate on the
        # order key, so the shuffle carries one row per order and partition;
        # Catalyst drops this join when the delivery date is not read
        last_ship = (self.raw("lineitem").groupBy("l_orderkey")
                     .agg(F.max("l_shipdate").alias("last_ship")))
        joined = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
        return self._orders_from(joined, "last_ship + interval 1 day")

    @cached_property
    def orders_placed(self) -> DataFrame:
        """Orders as placed (no delivery date yet): row-wise, so it also works
        on a stream of raw orders."""
        return self._orders_from(self.raw("orders"), "cast(null as timestamp_ntz)")

    @staticmethod
    def _orders_from(o: DataFrame, delivered: str) -> DataFrame:
        return o.selectExpr(
            "cast(o_orderkey as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            f"{_case_sql('o_orderstatus', ORDER_STATUS, None)} as order_status",
            "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int)) as order_purchase_timestamp",
            "o_orderdate + interval 1 day as order_approved_at",
            "cast(null as timestamp_ntz) as order_delivered_carrier_date",
            f"{delivered} as order_delivered_customer_date",
            "o_orderdate + interval 90 days as order_estimated_delivery_date")

    _LINE_COLS = ("cast(l_orderkey as string) as order_id",
                  "cast(l_partkey as string) as product_id",
                  "cast(l_suppkey as string) as seller_id",
                  "l_shipdate as shipping_limit_date",
                  "cast(l_extendedprice as decimal(10,2)) as price",
                  "cast(l_quantity as decimal(10,2)) as freight_value")

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order items without the item number (what every report reads)."""
        return self.raw("lineitem").selectExpr(*self._LINE_COLS)

    @cached_property
    def order_items(self) -> DataFrame:
        """Order items keyed by (order_id, order_item_id).

        (l_orderkey, l_linenumber) is not unique in the test data, so the item
        number is rebuilt per order by (line number, part, supplier, price).
        The numbering is range-partitioned (``number_within_key``), so an
        order holding a large share of all lines is still numbered by many
        tasks.
        """
        from emporium.operators.numbering import number_within_key
        li = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_extendedprice", "l_quantity", "l_shipdate")
        numbered = number_within_key(li, ["l_orderkey"],
                                     ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                                     out="item_no")
        cols = list(self._LINE_COLS)
        cols.insert(1, "item_no as order_item_id")
        return numbered.selectExpr(*cols)

    @cached_property
    def order_items_raw(self) -> DataFrame:
        """Line items keyed by the raw (order, line number) pair, which repeats."""
        cols = list(self._LINE_COLS)
        cols.insert(1, "cast(l_linenumber as int) as order_item_id")
        return self.raw("lineitem").selectExpr(*cols)

    @cached_property
    def order_payments(self) -> DataFrame:
        # one scan of orders; orders whose key ends in 0 get a second
        # (voucher) payment through a generator instead of a second scan
        ptype = _case_sql("substring(o_orderpriority, 1, 1)", PAYMENT_TYPE, PAYMENT_TYPE_OTHER)
        return (self.raw("orders")
                .selectExpr("o_orderkey", "o_orderpriority", "o_totalprice",
                            "explode(sequence(1, if(o_orderkey % 10 = 0, 2, 1))) as seq")
                .selectExpr(
                    "cast(o_orderkey as string) as order_id",
                    "cast(seq as int) as payment_sequential",
                    f"if(seq = 1, {ptype}, 'voucher') as payment_type",
                    "cast(if(seq = 1, 1 + o_orderkey % 12, 1) as int) as payment_installments",
                    "if(seq = 1, cast(o_totalprice as decimal(10,2)), cast(10 as decimal(10,2)))"
                    " as payment_value"))

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self.raw("orders").where("o_orderkey % 3 = 0").selectExpr(
            "concat('r', cast(o_orderkey as string)) as review_id",
            "cast(o_orderkey as string) as order_id",
            "cast(case when o_orderkey % 30 != 0 then 1 + o_custkey % 5 end as int) as review_score",
            "cast(null as string) as review_comment_title",
            "cast(null as string) as review_comment_message",
            "o_orderdate + interval 20 days as review_creation_date",
            "o_orderdate + interval 23 days as review_answer_timestamp")

    # ------------------------------------------------------ re-aimed tables
    @cached_property
    def metric_samples(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_type as metric",
            "map('city', concat('city_', cast(user_id % 4 as string))) as labels",
            "ts", "value",
            "event_type != 'error' as ok")

    @cached_property
    def points(self) -> DataFrame:
        return self.raw("embeddings").selectExpr(
            "vec_id as point_id",
            "cast(embedding[0] as double) as x",
            "cast(embedding[1] as double) as y",
            "cast(embedding[2] as double) as z")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    LOGICAL = ("customers", "geolocation", "orders", "order_items",
               "order_payments", "order_reviews", "products", "sellers",
               "translation")
