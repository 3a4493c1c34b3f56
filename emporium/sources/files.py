"""File and database sources for the logical tables and metric inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators.metrics import parse_exposition

S, I, TS = T.StringType(), T.IntegerType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Declared schemas of the nine marketplace tables (column order of the CSVs).
SCHEMAS = {
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", I), ("customer_city", S),
                         ("customer_state", S)),
    "geolocation": _schema(("geolocation_zip_code_prefix", I),
                           ("geolocation_lat", T.DecimalType(10, 6)),
                           ("geolocation_lng", T.DecimalType(10, 6)),
                           ("geolocation_city", S), ("geolocation_state", S)),
    "order_items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", TS),
                           ("price", T.DecimalType(10, 2)), ("freight_value", T.DecimalType(10, 2))),
    "order_payments": _schema(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                              ("payment_installments", I), ("payment_value", T.DecimalType(10, 2))),
    "order_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", I),
                             ("review_comment_title", S), ("review_comment_message", S),
                             ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                      ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
                      ("order_estimated_delivery_date", TS)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", I), ("product_description_lenght", I),
                        ("product_photos_qty", I), ("product_weight_g", I),
                        ("product_length_cm", I), ("product_height_cm", I),
                        ("product_width_cm", I)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S),
                       ("seller_state", S)),
    "translation": _schema(("product_category_name", S), ("product_category_name_english", S)),
}

# Unique keys the load de-duplicates on (geolocation: all columns).
KEYS = {
    "customers": ["customer_id"],
    "geolocation": None,
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "translation": ["product_category_name"],
}

# Parents before children, the order in which tables are loaded.
LOAD_ORDER = ["customers", "geolocation", "translation", "products", "sellers", "orders",
              "order_items", "order_payments", "order_reviews"]


# Tables with free text, whose quoted fields may hold newlines.
FREE_TEXT = {"order_reviews"}


def read_csv_table(spark: SparkSession, name: str, path: str, *, with_position: bool = True,
                   mode: str = "FAILFAST", multi_line: bool | None = None) -> DataFrame:
    """CSV with header in the declared schema, as ``COPY ... CSV HEADER`` reads it.

    * quoted fields may contain the delimiter and doubled quotes
      (``escape='"'``) and, with ``multi_line``, newlines;
    * an empty unquoted field is NULL and a quoted empty string ``""`` stays
      an empty string (``nullValue='\\N'``, ``emptyValue=''``) — with
      Spark's defaults both would become NULL;
    * any malformed row aborts the whole read (``FAILFAST``), like COPY.

    ``with_position`` adds ``_source_file`` and ``_source_pos`` (the file and
    a monotonically increasing id, which follows file order within a file)
    so that "first row wins" can be decided later.

    ``multi_line`` is on for the ``FREE_TEXT`` tables unless given.  Such files
    are not split, so each is read by one task: deliver large ones as many
    files.  The other tables' files are split; a newline inside a field makes
    a malformed row there and aborts the read.
    """
    schema = SCHEMAS[name]
    if multi_line is None:
        multi_line = name in FREE_TEXT
    df = (spark.read.schema(schema)
          .option("header", True).option("multiLine", multi_line)
          .option("quote", '"').option("escape", '"')
          .option("nullValue", "\\N").option("emptyValue", "")
          .option("mode", mode).option("encoding", "UTF-8")
          .csv(path))
    if with_position:
        df = df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                       F.monotonically_increasing_id().alias("_source_pos"))
    return df


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 search_path: str | None = None) -> dict:
    """Options for ``spark.read.format('jdbc')`` reading a table or a query.

    Give ``partition_column`` with bounds and ``num_partitions`` so the read
    is split into parallel range queries instead of one connection pulling
    the whole table.  ``search_path`` sets the schema like the reference's
    connection options.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if search_path is not None:
        opts["sessionInitStatement"] = f"SET search_path TO {search_path}"
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def read_exposition(spark: SparkSession, path: str) -> DataFrame:
    """Metrics text files (``name{labels} value`` lines) → samples with file mtime as ts."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_modification_time").alias("ts"))
    return parse_exposition(lines)


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """Saved weather responses: JSON lines with ``city``, ``ts``, ``ok`` and the raw ``body``."""
    schema = "city string, ts timestamp, ok boolean, body string"
    return spark.read.schema(schema).json(path)


def read_points(spark: SparkSession, path: str, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """Points (point_id, x, y, z) from the first three components of a vector column."""
    df = spark.read.parquet(path)
    v = F.col(vector_col)
    return df.select(F.col(id_col).alias("point_id"), v[0].cast("double").alias("x"),
                     v[1].cast("double").alias("y"), v[2].cast("double").alias("z"))


def scan_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Full table scan of a Parquet table (``SELECT * FROM t``)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_stream(spark: SparkSession, folder: str, schema, file_glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream of rows (continuous inserts)."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)
