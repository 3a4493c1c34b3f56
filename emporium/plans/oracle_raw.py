"""DuckDB SQL over the raw tables for reports that join and group.

The reports join the logical tables and then group; here each grouped amount
is worked out on the raw keys first (per order, part, customer or supplier)
and names are attached last, so the two agree only if both are right.
"""

from __future__ import annotations

PLACED = "o_orderdate + to_hours((o_orderkey % 24)::INT)"
PRICE = "l_extendedprice::DECIMAL(10,2)"
CATEGORY = "CASE WHEN p_partkey % 50 <> 0 THEN p_brand END"
ENGLISH = f"""CASE WHEN p_brand LIKE '%7' THEN {CATEGORY}
            WHEN p_partkey % 50 <> 0 THEN replace(lower(p_brand), '#', '_') END"""

BASKET = f"""basket AS (
  SELECT l_orderkey AS k, count(*) AS lines, max(l_shipdate) AS shipped,
         sum({PRICE} + l_quantity::DECIMAL(10,2)) AS total
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY ALL)"""

#: What each customer's orders cost, by the customer's state.
SPENT = f"""{BASKET},
spent AS (
  SELECT o_custkey, sum(total) AS total, count(*) AS n
  FROM basket, orders WHERE k = o_orderkey GROUP BY ALL),
by_state AS (
  SELECT n_name, sum(total) AS total, sum(n) AS n
  FROM nation, (FROM customer SEMI JOIN spent ON c_custkey = o_custkey) AS buyer, spent
  WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey GROUP BY ALL)"""

PAID = """paid AS (
  SELECT o_orderkey, unnest(list_concat(
           [coalesce(map(['1', '2', '3', '4'], ['credit_card', 'boleto', 'voucher', 'debit_card'])[o_orderpriority[1]],
                     'not_defined')],
           CASE WHEN o_orderkey % 10 = 0 THEN ['voucher'] ELSE [] END)) AS payment_type
  FROM orders)"""

#: Sales of a part in a year, then of a category.
YEARLY = f"""sold AS (
  SELECT l_partkey, year({PLACED}) AS year, sum({PRICE}) AS revenue
  FROM lineitem, orders
  WHERE l_orderkey = o_orderkey AND {PLACED} >= '1996-01-01' AND {PLACED} < '1999-01-01' GROUP BY ALL),
ranked AS (
  SELECT {ENGLISH} AS category, year::INT AS year, sum(revenue) AS revenue
  FROM part, sold WHERE p_partkey = l_partkey GROUP BY ALL
  ORDER BY sum(revenue) DESC NULLS FIRST, category NULLS LAST, year LIMIT 30)"""

#: Orders by month and state of the five states with most.
STATES = f"""monthly AS (
  SELECT n_name AS state, date_trunc('month', {PLACED})::DATE AS month, count(*) AS n
  FROM nation, customer, orders WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey
    AND n_name IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (PARTITION BY state) AS whole FROM monthly),
foremost AS (
  SELECT month, state, n::INT AS orders_count FROM summed
  QUALIFY dense_rank() OVER (ORDER BY whole DESC, state) <= 5)"""

GRID = f"""{STATES},
span AS (SELECT min(month) AS first, max(month) AS last FROM foremost),
grid AS (
  SELECT DISTINCT state, unnest(generate_series(first::TIMESTAMP, last::TIMESTAMP, to_months(1)))::DATE AS month
  FROM foremost, span),
dense AS (
  SELECT state, month, sum(orders_count)::INT AS orders_count
  FROM (FROM foremost UNION ALL BY NAME SELECT state, month, 0 AS orders_count FROM grid) GROUP BY ALL)"""

LOOKUP = f"""SELECT o_orderkey::VARCHAR AS order_id,
       map(['F', 'O', 'P'], ['delivered', 'shipped', 'processing'])[o_orderstatus] AS order_status,
       {PLACED} AS order_purchase_timestamp,
       (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) + to_days(1) AS order_delivered_customer_date,
       c_custkey::VARCHAR AS customer_id, c_name AS customer_unique_id,
       concat(n_name, ' ', c_mktsegment) AS customer_city, n_name AS customer_state
FROM nation, customer, orders"""


def _best(names: str, rest: str, order: str, k: int = 10) -> str:
    """The first ``k`` rows of a query by its own columns."""
    return f"SELECT {names} FROM ({rest}) QUALIFY row_number() OVER (ORDER BY {order}) <= {k}"


RAW_ORACLES = {
    "q07_avg_order_total_by_state": f"""WITH {SPENT}
SELECT n_name AS customer_state, total::DOUBLE / n::DOUBLE AS avg_order_total FROM by_state""",

    "q08_top_sellers": """
SELECT l_suppkey::VARCHAR AS seller_id, count(*) AS items_sold
FROM lineitem WHERE l_suppkey IN (FROM supplier SELECT s_suppkey) GROUP BY l_suppkey
QUALIFY row_number() OVER (ORDER BY count(*) DESC, l_suppkey::VARCHAR) <= 10""",

    "q10_top_categories_items": _best("*", f"""
  SELECT {CATEGORY} AS product_category_name, sum(n)::BIGINT AS items_count
  FROM part, (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
  WHERE p_partkey = l_partkey GROUP BY ALL""", "items_count DESC, product_category_name NULLS LAST"),

    "q11_monthly_revenue": f"""WITH {BASKET}
SELECT date_trunc('month', {PLACED})::DATE AS month, sum(total)::DOUBLE AS monthly_revenue
FROM basket, orders WHERE k = o_orderkey GROUP BY ALL""",

    "q12_payment_fanout_counts": f"""WITH {BASKET}, {PAID}
SELECT payment_type, sum(lines)::BIGINT AS cnt FROM paid, basket WHERE k = o_orderkey GROUP BY ALL""",

    "q12b_payment_fanout_share": f"""WITH {BASKET}, {PAID},
counted AS (SELECT payment_type, sum(lines) AS n FROM paid, basket WHERE k = o_orderkey GROUP BY ALL)
SELECT payment_type, n::BIGINT AS cnt,
       ((2000 * n + sum(n) OVER ()) // (2 * sum(n) OVER ()))::DOUBLE / 10.0 AS share_percent FROM counted""",

    "q13_top_categories_english": _best("category, revenue::DOUBLE AS revenue", f"""
  SELECT {ENGLISH} AS category, sum(amount) AS revenue
  FROM part, (SELECT l_partkey, sum({PRICE}) AS amount FROM lineitem GROUP BY ALL)
  WHERE p_partkey = l_partkey GROUP BY ALL""", "revenue DESC NULLS FIRST, category NULLS LAST"),

    "q14_category_year_revenue": f"""WITH {YEARLY}
SELECT category, year, revenue::DOUBLE AS revenue FROM ranked""",

    "q14b_category_year_top10": f"""WITH {YEARLY},
shown AS (SELECT category, year, revenue::DOUBLE AS revenue FROM ranked),
chosen AS (
  SELECT category FROM shown WHERE category IS NOT NULL GROUP BY category
  QUALIFY row_number() OVER (ORDER BY sum(revenue) DESC, category) <= 10),
slots AS (SELECT category, unnest([1996, 1997, 1998])::INT AS year FROM chosen)
SELECT category, year, sum(revenue) AS revenue
FROM (FROM shown SEMI JOIN chosen USING (category)
      UNION ALL BY NAME SELECT category, year, 0.0::DOUBLE AS revenue FROM slots) GROUP BY ALL""",

    "q15_review_by_category_min50": _best("*", f"""
  SELECT {ENGLISH} AS category,
         ((2000 * sum(points) + sum(n)) // (2 * sum(n)))::DOUBLE / 1000.0 AS avg_score, sum(n)::BIGINT AS n_reviews
  FROM part, (SELECT l_partkey, sum(1 + o_custkey % 5) AS points, count(*) AS n
              FROM lineitem, orders
              WHERE l_orderkey = o_orderkey AND o_orderkey % 3 = 0 AND o_orderkey % 30 <> 0 GROUP BY ALL)
  WHERE p_partkey = l_partkey GROUP BY ALL HAVING sum(n) >= 50""",
        "avg_score DESC, n_reviews DESC, category NULLS LAST"),

    "q16_per_order_totals": f"""WITH {BASKET}
SELECT k::VARCHAR AS order_id, (CASE WHEN k % 10 = 0 THEN total + total ELSE total END)::DOUBLE AS order_total
FROM basket""",

    "q17_delivery_vs_total": f"""WITH {BASKET}
SELECT k::VARCHAR AS order_id,
       (epoch_us(shipped + to_days(1)) - epoch_us({PLACED}))::DOUBLE / 86400e6::DOUBLE AS delivery_days,
       (CASE WHEN k % 10 = 0 THEN total + total ELSE total END)::DOUBLE AS order_total
FROM basket, orders
WHERE k = o_orderkey AND shipped + to_days(1) >= {PLACED} AND shipped + to_days(1) <= {PLACED} + to_days(60)""",

    "q18_state_order_totals": f"""WITH {SPENT}
SELECT n_name AS customer_state,
       ((2 * (total * 100)::HUGEINT * 100 + 100 * n) // (200 * n))::DOUBLE / 100.0 AS avg_order_total,
       n::BIGINT AS n_orders
FROM by_state""",

    "q20_top5_state_series": f"WITH {STATES} FROM foremost",
    "q20b_series_zero_filled": f"WITH {GRID} FROM dense",
    "q20c_cumulative_frames": f"""WITH {GRID}
SELECT unnest(list_filter((SELECT list(DISTINCT month) FROM grid), lambda m: m >= month)) AS frame, * FROM dense""",
    "q20d_axis_range": f"""WITH {GRID}
SELECT first AS x_min, last AS x_max, (SELECT max(orders_count) FROM dense)::DOUBLE * 1.1::DOUBLE AS y_max
FROM span WHERE first IS NOT NULL""",

    "q34_states_with_orders": """
SELECT n_name AS customer_state, sum(n)::BIGINT AS avg_orders
FROM nation, customer, (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL)
WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey GROUP BY ALL""",

    # a row's rank is one more than the number of dearer rows
    "q35_top3_price_rank": f"""WITH
priced AS (
  SELECT {CATEGORY} AS category, {PRICE} AS price, count(*) AS n
  FROM part, lineitem WHERE p_partkey = l_partkey GROUP BY ALL),
dearer AS (
  SELECT category, n, coalesce(sum(n) OVER (PARTITION BY category ORDER BY price DESC NULLS FIRST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM priced)
SELECT category AS product_category_name, unnest(list_transform(range(n), lambda x: (above + 1)::INT)) AS price_rank
FROM dearer WHERE above < 3""",

    "q37_orders_by_customer": f"""{LOOKUP}
WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey AND c_custkey = 1000""",

    "q38_orders_by_city": f"""{LOOKUP}
WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey
  AND regexp_full_match(n_name, '(?i)nation.1') AND lower(c_mktsegment) = 'building'""",
}
