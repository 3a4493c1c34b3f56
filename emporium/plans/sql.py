"""Reports written as Spark SQL text with bound parameters.

The reference sends SQL text with values bound beside it (``%s``).  Spark
SQL does the same with named parameter markers (``:name`` + ``args=``) and
DataFrame references (``{orders}`` + keyword DataFrames), which become
temporary views scoped to the one statement, so several scale factors can
be queried in one session without clashing view names.  Catalyst plans this
text exactly like the DataFrame versions in ``reports.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Monthly revenue: per-order totals first (an order belongs to the month it
# was placed in), then summed per month.
MONTHLY_REVENUE = """
SELECT month, CAST(SUM(order_total) AS DOUBLE) AS monthly_revenue
FROM (
  SELECT order_id,
         trunc(to_date(max(order_purchase_timestamp)), 'MM') AS month,
         SUM(price + freight_value) AS order_total
  FROM {orders} JOIN {order_items} USING (order_id)
  GROUP BY order_id
) per_order
GROUP BY month
ORDER BY month
"""

# One customer's orders, newest first; the id is a bound parameter.
ORDERS_BY_CUSTOMER = """
SELECT order_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
       customer_id, customer_unique_id, customer_city, customer_state
FROM {orders} JOIN {customers} USING (customer_id)
WHERE customer_id = :customer_id
ORDER BY order_purchase_timestamp DESC NULLS LAST, order_id
"""

# Latest purchase day of the id-prefixed orders placed since :start, and the
# number of such orders on that day (a correlated scalar subquery); when
# there is none, the day before :start and 0.
LAST_DAY_AND_COUNT = """
WITH tagged AS (
  SELECT to_date(order_purchase_timestamp) AS day,
         order_purchase_timestamp >= CAST(:start AS TIMESTAMP_NTZ) AS recent
  FROM {orders}
  WHERE order_id LIKE concat(:prefix, '%')
), latest AS (
  SELECT max(day) AS day FROM tagged WHERE recent
)
SELECT coalesce(l.day, date_sub(CAST(:start AS DATE), 1)) AS last_day,
       CAST((SELECT count(*) FROM tagged t WHERE t.day = l.day) AS BIGINT) AS cnt
FROM latest l
"""


def q11_monthly_revenue_sql(s) -> DataFrame:
    return s.spark.sql(MONTHLY_REVENUE, orders=s.orders, order_items=_lines(s))


def q37_orders_by_customer_sql(s, customer_id: str = "1000") -> DataFrame:
    return s.spark.sql(ORDERS_BY_CUSTOMER, args={"customer_id": customer_id},
                       orders=s.orders, customers=s.customers)


def q40_last_day_and_count_sql(s, id_prefix: str = "12", start: str = "1998-01-01") -> DataFrame:
    return s.spark.sql(LAST_DAY_AND_COUNT, args={"prefix": id_prefix, "start": start},
                       orders=s.orders_between(F.lit(start).cast("date").cast("timestamp_ntz")))


def _lines(s) -> DataFrame:
    from emporium.plans.reports import lines
    return lines(s)


SQL_REPORTS = {
    "q11_monthly_revenue_sql": q11_monthly_revenue_sql,
    "q37_orders_by_customer_sql": q37_orders_by_customer_sql,
    "q40_last_day_and_count_sql": q40_last_day_and_count_sql,
}
