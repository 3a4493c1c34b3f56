"""Hand-written DuckDB SQL for the registered table jobs (see ``jobs.py``)."""

from __future__ import annotations

from emporium.plans.oracle import with_views

AS_OF = "TIMESTAMP '2001-08-01 12:00:00'"
ITEM_COLS = """order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"""


def uniform(key_sql: str, seed: int) -> str:
    """Seeded uniform [0,1) from the MD5 of key || '#seed' (first 32 bits)."""
    return (f"(CAST(CAST(('0x' || substr(md5({key_sql} || '#{seed}'), 1, 8)) AS BIGINT) AS DOUBLE)"
            f" / CAST(4294967296 AS DOUBLE))")


_INSERT_ITEMS = with_views("order_items order_items_raw", f"""
, batch AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
             ORDER BY shipping_limit_date, product_id, seller_id, price, freight_value) AS rn
  FROM order_items_raw)
SELECT {ITEM_COLS} FROM order_items
UNION ALL
SELECT {ITEM_COLS} FROM batch b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM order_items t
                             WHERE t.order_id = b.order_id AND t.order_item_id = b.order_item_id)""")

_PICK_STALE = f"""
, pick AS (
  SELECT order_id FROM ord
  WHERE order_id LIKE '12' || '%' AND order_purchase_timestamp < {AS_OF} - INTERVAL 1 HOUR
  ORDER BY order_purchase_timestamp, order_id LIMIT 15)"""

_CLIPPED = """
, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1
        FROM points),
c AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, (z0 + z1) / 2 AS cz FROM b),
s AS (SELECT cx + (x0 - cx) * 1.02 AS x0, cx + (x1 - cx) * 1.02 AS x1,
             cy + (y0 - cy) * 1.02 AS y0, cy + (y1 - cy) * 1.02 AS y1,
             cz + (z0 - cz) * 1.02 AS z0, cz + (z1 - cz) * 1.02 AS z1 FROM c),
cropped AS (SELECT p.* FROM points p, s
            WHERE p.x BETWEEN s.x0 AND s.x1 AND p.y BETWEEN s.y0 AND s.y1 AND p.z BETWEEN s.z0 AND s.z1),
b2 AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1
       FROM cropped),
c2 AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, (z0 + z1) / 2 AS cz FROM b2),
s2 AS (SELECT cx + (x0 - cx) * 1.02 AS x0, cx + (x1 - cx) * 1.02 AS x1,
              cy + (y0 - cy) * 1.02 AS y0, cy + (y1 - cy) * 1.02 AS y1,
              cz + (z0 - cz) * 1.02 AS z0, cz + (z1 - cz) * 1.02 AS z1, cx, cy FROM c2),
plane AS (SELECT cx AS plane_x, cy AS plane_y,
                 z0 - 0.05 + (y1 - y0) * 1.5 / 2 AS plane_z,
                 (x1 - x0) * 1.5 AS width, CAST(0.01 AS DOUBLE) AS height, (y1 - y0) * 1.5 AS depth FROM s2),
clipped AS (SELECT p.* FROM points p, plane WHERE (p.y - plane.plane_y) * 1.0 < 0)"""

JOB_ORACLES = {
    "load_insert_if_absent_items": _INSERT_ITEMS,
    "load_insert_if_absent_twice": _INSERT_ITEMS,
    "stream_ingest_items": _INSERT_ITEMS,

    "load_geolocation_distinct": with_views("geolocation", """
SELECT geolocation_zip_code_prefix, CAST(geolocation_lat AS DOUBLE) AS geolocation_lat,
       CAST(geolocation_lng AS DOUBLE) AS geolocation_lng, geolocation_city, geolocation_state
FROM geolocation"""),

    "dml_u1_mark_delivered": with_views("ord", f"""
, pick AS (
  SELECT order_id FROM ord
  WHERE order_status = 'shipped' AND order_purchase_timestamp < {AS_OF} - INTERVAL 2 DAY
  ORDER BY order_purchase_timestamp, order_id LIMIT 5)
SELECT o.order_id, o.customer_id,
       CASE WHEN p.order_id IS NOT NULL THEN 'delivered' ELSE o.order_status END AS order_status,
       o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
       CASE WHEN p.order_id IS NOT NULL THEN {AS_OF} ELSE o.order_delivered_customer_date END
         AS order_delivered_customer_date,
       o.order_estimated_delivery_date
FROM ord o LEFT JOIN pick p ON o.order_id = p.order_id"""),

    "dml_u2_products": with_views("products", f"""
, pick AS (
  SELECT product_id FROM products WHERE product_id LIKE '1' || '%'
  ORDER BY md5(product_id || '#1'), product_id LIMIT 3)
SELECT p.product_id, p.product_category_name, p.product_name_lenght, p.product_description_lenght,
       CASE WHEN k.product_id IS NOT NULL THEN GREATEST(1, p.product_photos_qty - 1)
            ELSE p.product_photos_qty END AS product_photos_qty,
       CASE WHEN k.product_id IS NOT NULL
            THEN CAST(round_even(p.product_weight_g + {uniform('p.product_id', 2)} * CAST(10 AS DOUBLE), 0) AS INTEGER)
            ELSE p.product_weight_g END AS product_weight_g,
       p.product_length_cm, p.product_height_cm, p.product_width_cm
FROM products p LEFT JOIN pick k ON p.product_id = k.product_id"""),

    "dml_u3_price_jitter": with_views("ord order_items", f"""
, pick AS (
  SELECT order_id FROM ord WHERE order_purchase_timestamp > {AS_OF} - INTERVAL 1 HOUR
  ORDER BY order_purchase_timestamp, order_id LIMIT 10)
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
       CAST(CASE WHEN k.order_id IS NOT NULL
            THEN CAST(round(i.price * CAST(0.9 + {uniform("i.order_id || '/' || CAST(i.order_item_id AS VARCHAR)", 3)}
                                            * 0.2 AS DECIMAL(12,10)), 2) AS DECIMAL(10,2))
            ELSE i.price END AS DOUBLE) AS price,
       CAST(i.freight_value AS DOUBLE) AS freight_value
FROM order_items i LEFT JOIN pick k ON i.order_id = k.order_id"""),

    "dml_u4_city_rename": with_views("customers", """
, pick AS (
  SELECT customer_id FROM customers WHERE customer_id LIKE '1' || '%'
  ORDER BY md5(customer_id || '#4'), customer_id LIMIT 8)
SELECT c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix,
       CASE WHEN k.customer_id IS NULL THEN c.customer_city
            WHEN c.customer_city = 'NATION_1 BUILDING' THEN 'Nation 1 Building'
            WHEN c.customer_city = 'NATION_2 MACHINERY' THEN 'Nation 2 Machinery'
            ELSE c.customer_city END AS customer_city,
       c.customer_state
FROM customers c LEFT JOIN pick k ON c.customer_id = k.customer_id"""),

    "dml_u5_installments": with_views("order_payments", """
, pick AS (
  SELECT DISTINCT order_id FROM (
    SELECT order_id FROM order_payments WHERE payment_type = 'credit_card'
    ORDER BY md5(order_id || '/' || CAST(payment_sequential AS VARCHAR) || '#5'), order_id,
             payment_sequential
    LIMIT 6) t)
SELECT p.order_id, p.payment_sequential, p.payment_type,
       CASE WHEN hit THEN p.payment_installments + 1 ELSE p.payment_installments END
         AS payment_installments,
       CAST(CASE WHEN hit THEN CAST(round(p.payment_value * 1.1, 2) AS DECIMAL(10,2))
                 ELSE p.payment_value END AS DOUBLE) AS payment_value
FROM (SELECT op.*, (op.payment_type = 'credit_card' AND k.order_id IS NOT NULL) AS hit
      FROM order_payments op LEFT JOIN pick k ON op.order_id = k.order_id) p"""),

    "dml_delete_stale_orders": with_views("ord order_items order_payments order_reviews", _PICK_STALE + """
, n AS (
  SELECT (SELECT count(*) FROM order_items WHERE order_id IN (SELECT order_id FROM pick))
       + (SELECT count(*) FROM order_payments WHERE order_id IN (SELECT order_id FROM pick))
       + (SELECT count(*) FROM order_reviews WHERE order_id IN (SELECT order_id FROM pick)) AS n)
SELECT o.* FROM ord o
WHERE o.order_id NOT IN (SELECT order_id FROM pick) OR (SELECT n FROM n) > 0"""),

    "dml_delete_orders_cascade": f"""WITH doomed AS (
  SELECT o_orderkey AS k FROM orders
  WHERE left(o_orderkey::VARCHAR, 2) = '12'
    AND o_orderdate + to_hours((o_orderkey % 24)::INT) < {AS_OF} - to_hours(1)
  QUALIFY row_number() OVER (ORDER BY o_orderdate + to_hours((o_orderkey % 24)::INT), o_orderkey::VARCHAR) <= 150),
remain AS (FROM orders ANTI JOIN doomed ON o_orderkey = k)
SELECT 'orders' AS table_name, o_orderkey::VARCHAR AS order_id, NULL::VARCHAR AS part FROM remain
UNION ALL
SELECT 'order_items', l_orderkey::VARCHAR,
       (row_number() OVER (PARTITION BY l_orderkey))::VARCHAR FROM lineitem ANTI JOIN doomed ON l_orderkey = k
UNION ALL
SELECT 'order_payments', o_orderkey::VARCHAR,
       unnest(CASE WHEN o_orderkey % 10 = 0 THEN ['1', '2'] ELSE ['1'] END) FROM remain
UNION ALL
SELECT 'order_reviews', o_orderkey::VARCHAR, 'r' || o_orderkey FROM remain WHERE o_orderkey % 3 = 0""",

    "dml_city_rename_all": """
SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_unique_id,
       (1000 + c_custkey % 500)::INT AS customer_zip_code_prefix, n_name AS customer_state,
       CASE WHEN n_name = 'NATION_1' AND c_mktsegment = 'BUILDING' THEN 'Nation 1 Building'
            WHEN n_name = 'NATION_2' AND c_mktsegment = 'MACHINERY' THEN 'Nation 2 Machinery'
            ELSE n_name || ' ' || c_mktsegment END AS customer_city
FROM customer, nation WHERE n_nationkey = c_nationkey AND left(c_custkey::VARCHAR, 1) = '1'""",

    "quality_orphans_of_recall": with_views("order_items", f"""
SELECT {ITEM_COLS} FROM order_items
WHERE product_id::INT % 10 = 3 OR product_id::INT NOT IN (SELECT p_partkey FROM part)"""),

    "quality_accepted_customers": """
SELECT c_custkey::VARCHAR AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR ELSE c_name END AS customer_unique_id,
       (1000 + c_custkey % 500)::INT AS customer_zip_code_prefix,
       CASE WHEN c_custkey % 5 = 0 THEN 'unknown' ELSE n_name || ' ' || c_mktsegment END AS customer_city,
       CASE c_custkey % 4 WHEN 0 THEN n_name[1:2] WHEN 2 THEN 'NA' ELSE n_name END AS customer_state
FROM customer, nation
WHERE n_nationkey = c_nationkey AND c_custkey % 7 <> 0
  AND (c_custkey % 4 IN (0, 2) OR (c_custkey % 4 = 3 AND length(n_name) <= 5))""",

    "quality_accepted_sellers": """
SELECT s_suppkey::VARCHAR AS seller_id, (1000 + s_suppkey % 500)::INT AS seller_zip_code_prefix,
       CASE WHEN s_suppkey % 5 = 0 THEN 'unknown' ELSE lower(n_name) END AS seller_city,
       CASE WHEN s_suppkey % 2 = 0 THEN right(n_name, 3) ELSE n_name END AS seller_state
FROM supplier, nation
WHERE n_nationkey = s_nationkey AND s_suppkey % 7 <> 0 AND (s_suppkey % 2 = 0 OR length(n_name) <= 5)""",

    "quality_accepted_orders": """
SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'created'
            ELSE coalesce(map(['F', 'O', 'P'], ['delivered', 'shipped', 'processing'])[o_orderstatus], 'created')
            END AS order_status
FROM orders""",

    # the last event of a city that is no error and has a whole body gives its nine gauges
    "metrics_weather_gauges": """
WITH good AS (
  SELECT 'city_' || user_id % 4 AS city, ts, unnest([
           {'m': 'owm_temperature_celsius', 'v': value},
           {'m': 'owm_humidity_percent', 'v': CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 100 END},
           {'m': 'owm_wind_speed_ms', 'v': event_id % 30}, {'m': 'owm_feels_like_celsius', 'v': 0},
           {'m': 'owm_pressure_hpa', 'v': 0}, {'m': 'owm_clouds_percent', 'v': 0}, {'m': 'owm_visibility_m', 'v': 0},
           {'m': 'owm_rain_1h_mm', 'v': 0}, {'m': 'owm_snow_1h_mm', 'v': 0}]) AS g
  FROM events WHERE event_type <> 'error' AND event_id % 11 <> 0 AND value IS NOT NULL)
SELECT g.m AS metric, city, max(ts) AS ts, arg_max(g.v::DOUBLE, (ts, g.v::DOUBLE)) AS value
FROM good GROUP BY ALL""",

    "points_crop_lower_half": with_views("points", """
SELECT * FROM points WHERE z <= (SELECT min(z) + (max(z) - min(z)) * 0.5::DOUBLE FROM points)"""),

    "points_inner_box": with_views("points", """
, box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM points),
mid AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, (z0 + z1) / 2 AS cz FROM box)
SELECT point_id, x, y, z FROM points, mid
WHERE x >= cx + (x0 - cx) * 0.6::DOUBLE AND x <= cx + (x1 - cx) * 0.6::DOUBLE
  AND y >= cy + (y0 - cy) * 0.6::DOUBLE AND y <= cy + (y1 - cy) * 0.6::DOUBLE
  AND z >= cz + (z0 - cz) * 0.6::DOUBLE AND z <= cz + (z1 - cz) * 0.6::DOUBLE"""),

    "quality_duplicate_item_keys": with_views("order_items_raw", """
SELECT order_id, order_item_id, COUNT(*) AS n FROM order_items_raw
GROUP BY order_id, order_item_id HAVING COUNT(*) > 1"""),

    "quality_orphan_items": with_views("order_items products", f"""
SELECT {ITEM_COLS} FROM order_items i
WHERE i.product_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = i.product_id)"""),

    "quality_rejected_customers": with_views("customers", """
SELECT * FROM (
  SELECT customer_id,
         COALESCE(NULLIF(customer_unique_id, ''), customer_id) AS customer_unique_id,
         COALESCE(customer_zip_code_prefix, 0) AS customer_zip_code_prefix,
         COALESCE(customer_city, 'unknown') AS customer_city,
         trim(COALESCE(customer_state, 'NA')) AS customer_state,
         concat_ws('; ',
           CASE WHEN COALESCE(customer_zip_code_prefix, 0) < 0
                THEN 'customer_zip_code_prefix must be >= 0' END,
           CASE WHEN length(trim(COALESCE(customer_state, 'NA'))) NOT BETWEEN 1 AND 5
                THEN 'customer_state length must be 1..5' END) AS reason
  FROM customers) v
WHERE reason <> ''"""),

    "metrics_latest_gauges": with_views("metric_samples", """
SELECT metric, ts, value, city FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, city ORDER BY ts DESC, value DESC) AS rn
  FROM metric_samples WHERE ok) t
WHERE rn = 1"""),

    "stream_latest_gauges": with_views("metric_samples", """
SELECT metric, ts, value, city FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, city ORDER BY ts DESC, value DESC) AS rn
  FROM metric_samples WHERE ok) t
WHERE rn = 1"""),

    "stream_daily_counts": """
SELECT CAST(o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS DATE) AS day, count(*) AS n
FROM orders GROUP BY 1""",

    # the first arrival of a key stays, in one arrival the first row
    "stream_dedupe_items": """
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber::INT AS order_item_id, l_partkey::VARCHAR AS product_id,
       l_suppkey::VARCHAR AS seller_id, l_shipdate AS shipping_limit_date,
       l_extendedprice::DECIMAL(10,2)::DOUBLE AS price, l_quantity::DECIMAL(10,2)::DOUBLE AS freight_value
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_suppkey % 3, l_shipdate, l_partkey::VARCHAR, l_suppkey::VARCHAR,
           l_extendedprice::DECIMAL(10,2), l_quantity::DECIMAL(10,2)) = 1""",

    # what arrives again is changed, and ignored
    "stream_ingest_orders": """
SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id,
       map(['F', 'O', 'P'], ['delivered', 'shipped', 'processing'])[o_orderstatus] AS order_status,
       o_orderdate + to_hours((o_orderkey % 24)::INT) AS order_purchase_timestamp,
       o_orderdate + to_days(1) AS order_approved_at, NULL::TIMESTAMP AS order_delivered_carrier_date,
       NULL::TIMESTAMP AS order_delivered_customer_date, o_orderdate + to_days(90) AS order_estimated_delivery_date
FROM orders""",

    "stream_ingest_payments": with_views("order_payments", """
SELECT order_id, payment_sequential, payment_type, payment_installments,
       payment_value::DOUBLE AS payment_value
FROM order_payments"""),

    "metrics_api_health_hourly": with_views("metric_samples", """
SELECT date_trunc('hour', ts) AS round, CAST(bool_and(ok) AS INTEGER) AS up, max(ts) AS last_update
FROM metric_samples GROUP BY 1"""),

    "metrics_resample_last_15m": with_views("metric_samples", """
SELECT step_start, metric, value, city FROM (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS step_start, metric, city, value,
         row_number() OVER (PARTITION BY metric, city, time_bucket(INTERVAL 15 MINUTE, ts)
                            ORDER BY ts DESC, value DESC) AS rn
  FROM metric_samples) t
WHERE rn = 1"""),

    "metrics_payment_share_samples": with_views("order_payments", """
, share AS (
  SELECT payment_type, count_payments,
         CAST((20000 * count_payments + total) // (2 * total) AS DOUBLE) / 100.0 AS percent_share
  FROM (SELECT payment_type, COUNT(*) AS count_payments, SUM(COUNT(*)) OVER () AS total
        FROM order_payments GROUP BY payment_type) t)
SELECT 'payments_count_payments' AS metric, payment_type, CAST(count_payments AS DOUBLE) AS value
FROM share
UNION ALL
SELECT 'payments_percent_share', payment_type, percent_share FROM share"""),

    "metrics_relabel_instance": with_views("metric_samples", """
SELECT metric, city, 'external_apis' AS instance, ts, value FROM metric_samples"""),

    "points_bbox": with_views("points", """
SELECT min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max,
       min(z) AS z_min, max(z) AS z_max,
       (min(x) + max(x)) / 2 AS x_center, (min(y) + max(y)) / 2 AS y_center,
       (min(z) + max(z)) / 2 AS z_center
FROM points"""),

    "points_crop": with_views("points", """
, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1
        FROM points)
SELECT p.* FROM points p, b
WHERE p.z BETWEEN b.z0 AND b.z0 + (b.z1 - b.z0) * CAST(1.0 AS DOUBLE)
  AND p.x BETWEEN b.x0 AND b.x1 AND p.y BETWEEN b.y0 AND b.y1"""),

    "points_scaled_crop": with_views("points", """
, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1
        FROM points),
c AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, (z0 + z1) / 2 AS cz FROM b),
s AS (SELECT cx + (x0 - cx) * 1.02 AS x0, cx + (x1 - cx) * 1.02 AS x1,
             cy + (y0 - cy) * 1.02 AS y0, cy + (y1 - cy) * 1.02 AS y1,
             cz + (z0 - cz) * 1.02 AS z0, cz + (z1 - cz) * 1.02 AS z1 FROM c)
SELECT p.* FROM points p, s
WHERE p.x BETWEEN s.x0 AND s.x1 AND p.y BETWEEN s.y0 AND s.y1 AND p.z BETWEEN s.z0 AND s.z1"""),

    "points_voxels": with_views("points", """
, b AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0 FROM points)
SELECT CAST(floor((p.x - b.x0) / CAST(0.05 AS DOUBLE)) AS BIGINT) AS vx,
       CAST(floor((p.y - b.y0) / CAST(0.05 AS DOUBLE)) AS BIGINT) AS vy,
       CAST(floor((p.z - b.z0) / CAST(0.05 AS DOUBLE)) AS BIGINT) AS vz,
       COUNT(*) AS n
FROM points p, b GROUP BY 1, 2, 3"""),

    "points_plane": with_views("points", _CLIPPED + """
SELECT * FROM plane"""),

    "points_clip": with_views("points", _CLIPPED + """
SELECT * FROM clipped"""),

    "points_color_by_height": with_views("points", _CLIPPED + """
, zb AS (SELECT min(z) AS zmin, max(z) AS zmax FROM clipped)
SELECT c.*, (c.z - zb.zmin) / (zb.zmax - zb.zmin + 1e-8) AS r, CAST(0.0 AS DOUBLE) AS g,
       1.0 - (c.z - zb.zmin) / (zb.zmax - zb.zmin + 1e-8) AS b
FROM clipped c, zb"""),

    "points_extremes": with_views("points", _CLIPPED + """
, lo AS (SELECT * FROM clipped ORDER BY z, point_id LIMIT 1),
hi AS (SELECT * FROM clipped ORDER BY z DESC, point_id LIMIT 1)
SELECT 'min' AS extreme, lo.*, hi.z - lo.z AS height_range FROM lo, hi
UNION ALL
SELECT 'max', hi.*, hi.z - lo.z FROM lo, hi"""),
}

_PROFILE_COLS = [
    ("product_id", False), ("product_category_name", False), ("product_name_lenght", True),
    ("product_description_lenght", True), ("product_photos_qty", True),
    ("product_weight_g", True), ("product_length_cm", True), ("product_height_cm", True),
    ("product_width_cm", True),
]


def _profile_sql() -> str:
    parts = []
    for pos, (name, numeric) in enumerate(_PROFILE_COLS, start=1):
        width = (f"CAST(LEAST(GREATEST(length('{name}'), COALESCE(max(length(CAST({name} AS VARCHAR))), 0))"
                 f" + 2, 40) AS INTEGER)")
        if numeric:
            stats = (f"CAST(count({name}) AS BIGINT), "
                     f"CASE WHEN count({name}) >= 2 THEN CAST(min({name}) AS DOUBLE) END, "
                     f"CASE WHEN count({name}) >= 2 THEN CAST(quantile_cont({name}, 0.5) AS DOUBLE) END, "
                     f"CASE WHEN count({name}) >= 2 THEN CAST(max({name}) AS DOUBLE) END")
        else:
            stats = "CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{name}' AS \"column\", {pos} AS position, {width} AS width, {stats} "
                     f"FROM products")
    body = "\nUNION ALL\n".join(parts)
    return with_views("products", f"""
SELECT "column", position, width, n_numeric, "min", p50, "max" FROM (
SELECT NULL AS "column", NULL AS position, NULL AS width, NULL AS n_numeric, NULL AS "min",
       NULL AS p50, NULL AS "max" WHERE FALSE
UNION ALL
{body}) t""")


JOB_ORACLES["profile_products"] = _profile_sql()

JOB_ORACLES["catalog_rows_total"] = with_views(
    "customers geolocation ord order_items order_payments order_reviews products sellers translation", """
SELECT CAST((SELECT COUNT(*) FROM customers) + (SELECT COUNT(*) FROM geolocation)
     + (SELECT COUNT(*) FROM ord) + (SELECT COUNT(*) FROM order_items)
     + (SELECT COUNT(*) FROM order_payments) + (SELECT COUNT(*) FROM order_reviews)
     + (SELECT COUNT(*) FROM products) + (SELECT COUNT(*) FROM sellers)
     + (SELECT COUNT(*) FROM translation) AS BIGINT) AS rows_total""")

JOB_ORACLES["load_bulk_from_csv"] = with_views(
    "customers geolocation ord order_items order_payments order_reviews products sellers translation", """
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customers
UNION ALL SELECT 'geolocation', COUNT(*) FROM geolocation
UNION ALL SELECT 'translation', COUNT(*) FROM translation
UNION ALL SELECT 'products', COUNT(*) FROM products
UNION ALL SELECT 'sellers', COUNT(*) FROM sellers
UNION ALL SELECT 'orders', COUNT(*) FROM ord
UNION ALL SELECT 'order_items', COUNT(*) FROM order_items
UNION ALL SELECT 'order_payments', COUNT(*) FROM order_payments
UNION ALL SELECT 'order_reviews', COUNT(*) FROM order_reviews""")

JOB_ORACLES["metrics_exposition_roundtrip"] = with_views("metric_samples", """
SELECT metric, city, value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, city ORDER BY ts DESC, value DESC) AS rn
  FROM metric_samples WHERE ok) t
WHERE rn = 1""")
