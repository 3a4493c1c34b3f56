"""The logical tables as bucketed catalog tables.

Most reports join orders with their items, payments or reviews on
``order_id``.  Saved bucketed by ``order_id`` into the same number of
buckets (and sorted by it), those tables are joined and aggregated per
order without shuffling either side: Spark plans a sort-merge join straight
over the bucket files.  Customers are bucketed by ``customer_id`` and
products by ``product_id`` for the same reason.  ``CatalogStar`` exposes the
saved tables under the attribute names the reports use, so every report
runs on them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# table → bucketing column; tables joined on the same column share a count
BUCKETING = {
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "order_id",
    "customers": "customer_id",
    "products": "product_id",
}
UNBUCKETED = ("geolocation", "sellers", "translation")


def save_bucketed(spark: SparkSession, star, database: str, buckets: int) -> None:
    """Write the nine logical tables of ``star`` into ``database``.

    ``buckets`` should make one bucket a few hundred MB of the largest
    table; the same count for all order-keyed tables keeps them co-located.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, key in BUCKETING.items():
        (star.table(name).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
         .saveAsTable(f"{database}.{name}"))
    for name in UNBUCKETED:
        star.table(name).write.mode("overwrite").saveAsTable(f"{database}.{name}")


class CatalogStar:
    """Logical tables read from a catalog database written by ``save_bucketed``."""

    LOGICAL = ("customers", "geolocation", "orders", "order_items", "order_payments",
               "order_reviews", "products", "sellers", "translation")

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def orders_between(self, since=None, until=None) -> DataFrame:
        """``orders``: the purchase time is stored, so the caller's filter reaches the scan."""
        return self.orders

    def __getattr__(self, name: str) -> DataFrame:
        if name == "order_lines":
            return self.spark.table(f"{self.database}.order_items").drop("order_item_id")
        if name in self.LOGICAL:
            return self.spark.table(f"{self.database}.{name}")
        raise AttributeError(name)



__all__ = ["BUCKETING", "CatalogStar", "save_bucketed"]
