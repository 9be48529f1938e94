"""SQL twins of the query catalogue, for DuckDB over the same tables.

They start from typed values instead of wire text, use integer cents and integer half-up rounding
instead of decimals, and windows or full outer joins where the Spark side aggregates or splits.
"""

from __future__ import annotations

FEED = """
feed AS (
  SELECT o_orderkey AS k, o_custkey AS c,
    CAST(o_orderkey AS VARCHAR) AS event_id,
    CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_custkey % 61 <> 0 THEN CAST(o_custkey % 100 AS VARCHAR) END AS merchant_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    ['food_delivery', 'packae_delivery', 'pharmacy', 'groceries'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS service_type,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'cancelled' ELSE 'en_route' END AS order_status,
    CASE WHEN o_orderkey % 67 = 0 THEN 'voucher'
         ELSE ['card', 'cash', 'wallet', 'bank_transfer'][CAST(o_orderkey % 4 AS INTEGER) + 1] END AS payment_method,
    ['pending', 'completed', 'failed', 'refunded'][CAST((o_orderkey // 4) % 4 AS INTEGER) + 1] AS payment_status,
    CASE WHEN o_orderkey % 97 = 0 THEN '0.00' WHEN o_orderkey % 89 = 0 THEN '-5.00'
         WHEN o_orderkey % 83 = 0 THEN 'n/a' WHEN o_orderkey % 79 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount_text,
    o_orderdate + to_microseconds(((o_orderkey * 7919) % 86400) * 1000000 + (o_orderkey % 10) * 100001) AS placed
  FROM orders),
timed AS (
  SELECT *, TRY_CAST(amount_text AS DECIMAL(18,2)) AS amount,
    CASE WHEN k % 73 <> 0 THEN placed END AS ts,
    CASE WHEN k % 71 <> 0 THEN placed + to_seconds((20 + (k * 31) % 60) * 60 + (k * 17) % 60) END AS eta
  FROM feed)"""

SILVER = (
    FEED
    + """,
silver AS (
  SELECT *, CAST(ts AS DATE) AS event_date,
    CAST((2 * CAST(epoch(date_trunc('second', eta)) - epoch(date_trunc('second', ts)) AS BIGINT) + 60) // 120 AS BIGINT)
      AS minutes
  FROM timed WHERE order_id IS NOT NULL AND merchant_id IS NOT NULL AND amount > 0),
flagged AS (SELECT *, COALESCE(minutes > 45, false) AS late FROM silver)"""
)

ITEMS = """
lines AS (
  SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, CAST(l_quantity AS BIGINT) AS q,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
  FROM lineitem),
items AS (
  SELECT k, CAST(k AS VARCHAR) AS order_id, 'line-' || line AS item_id, 'Dish ' || (part % 200) AS name,
    CAST(q AS INTEGER) AS quantity,
    CAST((2 * cents + q) // (2 * q) AS BIGINT) AS unit_cents, cents AS total_cents,
    CAST((2 * cents + q) // (2 * q) AS BIGINT) / 100.0 AS unit_price, cents / 100.0 AS total_price
  FROM lines)"""

MESSAGES = (
    FEED
    + """,
lists AS (
  SELECT l_orderkey AS k, l_linenumber // 64 AS chunk, '[' || string_agg(
      '{"item_id":"line-' || l_linenumber || '","name":"Dish ' || (l_partkey % 200)
      || '","quantity":' || CAST(l_quantity AS DOUBLE)
      || ',"unit_price":"' || CAST((2 * cents + q) // (2 * q) * 0.01::DECIMAL(3,2) AS VARCHAR)
      || '","total_price":"' || CAST(l_extendedprice AS DECIMAL(18,2))
      || '","options":{"cold":' || (l_quantity > 25) || '}}', ','
      ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) || ']' AS listed
  FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
    FROM lineitem) GROUP BY l_orderkey, l_linenumber // 64),
sent AS (
  SELECT t.*, listed, COALESCE(chunk, 0) * 1099511627776 + t.k * 2 + d AS "offset"
  FROM timed t LEFT JOIN lists USING (k), (VALUES (0), (1)) v(d))"""
)

COURIERS = """
couriers AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n, ts AS event_timestamp,
    CAST(user_id % 100 AS VARCHAR) AS merchant_id, CAST(user_id AS VARCHAR) AS courier_id,
    CAST(event_id * 2 AS VARCHAR) AS order_id,
    CASE event_type WHEN 'click' THEN 'assigned' WHEN 'view' THEN 'accepted' WHEN 'signup' THEN 'picked_up'
      WHEN 'purchase' THEN 'delivered' ELSE 'cancelled' END AS delivery_status,
    (event_id % 180) - 90 + 0.5::DOUBLE AS latitude, (event_id % 360) - 180 + 0.25::DOUBLE AS longitude,
    'Stop ' || (event_id % 500) AS address, value AS battery_level,
    ['Bicycle', 'Motorcycle', 'Van'][CAST(event_id % 3 AS INTEGER) + 1] AS vehicle_type,
    event_id % 5 <> 0 AS is_online, event_type = 'error' AS torn
  FROM events)"""

ROUTED = """
routed AS (
  SELECT *, CASE event_type WHEN 'purchase' THEN 'orders-raw' WHEN 'signup' THEN 'merchants-raw'
      WHEN 'click' THEN 'reviews-raw' ELSE 'couriers-raw' END AS topic,
    event_type = 'error' AS torn,
    TIMESTAMP '2024-02-01 00:00:00' + to_milliseconds(event_id * 360) AS landed
  FROM events),
records AS (
  SELECT *, CASE topic WHEN 'orders-raw' THEN CAST(event_id * 2 AS VARCHAR)
      WHEN 'merchants-raw' THEN CAST(user_id % 100 AS VARCHAR)
      WHEN 'reviews-raw' THEN 'r' || event_id
      ELSE COALESCE(CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END, CAST(event_id AS VARCHAR)) END AS key
  FROM routed)"""


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST((20000 * {part} + {whole}) // (2 * {whole}) AS BIGINT) / 100.0 END"


def _mean(total: str, n: str) -> str:
    """Mean of whole numbers at two decimals."""
    return f"CASE WHEN {n} > 0 THEN CAST((200 * {total} + {n}) // (2 * {n}) AS BIGINT) / 100.0 END"


def _mean_cents(cents: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST((2 * {cents} + {n}) // (2 * {n}) AS BIGINT) / 100.0 END"


def _sum(value: str, where: str = "true") -> str:
    return f"CAST(SUM(CASE WHEN {where} THEN {value} END) AS BIGINT)"


def _count(where: str) -> str:
    return f"COUNT(*) FILTER (WHERE {where})"


CENTS = "CAST(amount * 100 AS BIGINT)"
LAKE_TIME = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN {0} = date_trunc('second', {0}) THEN strftime({0}, '%Y-%m-%d %H:%M:%S') "
    "ELSE strftime({0}, '%Y-%m-%d %H:%M:%S.%f') END"
)

FULFILLMENT = f"""
fulfillment AS (
  SELECT event_date, COUNT(order_id) AS total_orders,
    {_count("order_status = 'delivered'")} AS delivered_orders,
    {_pct(_count("order_status = 'delivered'"), "COUNT(*)")} AS fulfillment_rate,
    {_count("order_status = 'cancelled'")} AS cancelled_orders,
    {_pct(_count("order_status = 'cancelled'"), "COUNT(*)")} AS cancellation_rate,
    {_pct(_count("late"), "COUNT(*)")} AS delay_rate
  FROM flagged GROUP BY event_date)"""

DELIVERY_TIME = f"""
delivery_time AS (
  SELECT event_date,
    {_mean(_sum("minutes"), "COUNT(minutes)")} AS avg_delivery_time,
    {_mean(_sum("minutes", "late"), _count("late"))} AS avg_delayed_delivery_time,
    {_mean(_sum("minutes", "NOT late"), _count("NOT late AND minutes IS NOT NULL"))} AS avg_ontime_delivery_time
  FROM flagged WHERE order_status = 'delivered' GROUP BY event_date)"""

ETA = f"""
eta_accuracy AS (
  SELECT event_date,
    {_mean(_sum("abs(minutes - 45)"), "COUNT(minutes)")} AS avg_eta_deviation,
    {_count("late")} AS delayed_deliveries,
    {_pct(_count("late"), "COUNT(*)")} AS delay_rate
  FROM flagged WHERE order_status = 'delivered' GROUP BY event_date)"""

HOURLY = f"""
hourly AS (
  SELECT event_date, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS orders FROM flagged GROUP BY 1, 2),
spread AS (
  SELECT event_date, COUNT(*) AS active_hours, {_mean(_sum("orders"), "COUNT(*)")} AS avg_orders_per_hour
  FROM hourly GROUP BY event_date)"""

VOLUME = f"""{HOURLY},
volume AS (
  SELECT f.event_date, COUNT(DISTINCT order_id) AS total_orders, {_sum(CENTS)} / 100.0 AS total_revenue,
    {_mean_cents(_sum(CENTS), "COUNT(*)")} AS avg_order_value,
    COUNT(DISTINCT merchant_id) AS active_merchants, COUNT(DISTINCT customer_id) AS active_customers,
    ANY_VALUE(active_hours) AS active_hours, ANY_VALUE(avg_orders_per_hour) AS avg_orders_per_hour
  FROM flagged f JOIN spread s ON f.event_date = s.event_date GROUP BY f.event_date)"""

HISTORY = """
history AS (
  SELECT order_id, ts AS event_timestamp, 'created' AS order_status, merchant_id FROM silver
  UNION ALL SELECT order_id, eta, order_status, merchant_id FROM silver)"""

SILVER_COLUMNS = """event_id, ts AS event_timestamp, order_id, merchant_id, customer_id, service_type, order_status,
    CAST(1000 AS FLOAT) AS delivery_fee, CAST(amount AS DOUBLE) AS total_amount, eta AS estimated_delivery_time,
    payment_method, payment_status, event_date,
    (c % 180) - 90 + 0.5::DOUBLE AS delivery_latitude, (c % 360) - 180 + 0.25::DOUBLE AS delivery_longitude,
    CAST(minutes AS DOUBLE) AS delivery_time_minutes, late AS is_delayed"""

ITEM_COLUMNS = "order_id, item_id, name, quantity, unit_price, total_price"


ORDER_REASON = """CASE WHEN order_id IS NULL THEN 'bad or missing order_id'
    WHEN ts IS NULL THEN 'bad or missing event_timestamp'
    WHEN amount IS NULL THEN 'bad or missing total_amount' END"""

CHECKS_SILVER = [
    ("order_id is null", "order_id IS NULL"),
    ("merchant_id is null", "merchant_id IS NULL"),
    ("total_amount <= 0", "amount <= 0"),
    ("event_timestamp is null", "ts IS NULL"),
    ("delay rule broken", "late <> COALESCE(minutes > 45, false)"),
]
CHECKS_ITEMS = [
    ("item_id is null", "item_id IS NULL"),
    ("quantity <= 0", "quantity <= 0"),
    ("total_price <= 0", "total_price <= 0"),
]
CHECKS_GOLD = [
    ("fulfillment_rate out of range", "fulfillment_rate NOT BETWEEN 0 AND 100"),
    ("more delivered than ordered", "delivered_orders > total_orders"),
    ("event_date is null", "event_date IS NULL"),
]


def _checks(table: str, checks: list[tuple[str, str]], layer: str | None = None) -> str:
    head = f"'{layer}' AS layer, " if layer else ""
    tail = ", {c} = 0 AS passed" if layer else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{name}' AS \"check\", {_count(cond)} AS failed{tail.format(c=_count(cond))} FROM {table}"
        for name, cond in checks
    )


def _domain(table: str, field: str, allowed: str, value: str | None = None) -> str:
    value = value or field
    return (
        f"SELECT '{field}' AS field, CAST({value} AS VARCHAR) AS value, COUNT(*) AS rows, {allowed} AS in_domain "
        f"FROM {table} GROUP BY {value}"
    )


def _in(field: str, values: list[str]) -> str:
    return f"COALESCE({field} IN ({', '.join(repr(v) for v in values)}), false)"


SCHEMA_ROWS = [
    ("event_id", "string", "event_id"),
    ("event_timestamp", "timestamp", "ts"),
    ("order_id", "string", "order_id"),
    ("merchant_id", "string", "merchant_id"),
    ("customer_id", "string", "customer_id"),
    ("service_type", "string", "service_type"),
    ("order_status", "string", "order_status"),
    ("delivery_fee", "float", "1"),
    ("total_amount", "double", "amount"),
    ("estimated_delivery_time", "timestamp", "eta"),
    ("payment_method", "string", "payment_method"),
    ("payment_status", "string", "payment_status"),
    ("event_date", "date", "event_date"),
    ("delivery_latitude", "double", "c"),
    ("delivery_longitude", "double", "c"),
    ("delivery_time_minutes", "double", "minutes"),
    ("is_delayed", "boolean", "late"),
]

DAYS = """
bounds AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS b FROM orders),
spine AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)"""

def sql() -> dict[str, str]:
    s, it = f"WITH {SILVER}", f"WITH {ITEMS}"
    both = f"WITH {SILVER}, {ITEMS}"
    q = {
        "bronze_scan": f"""WITH {FEED}
            SELECT event_id, CASE WHEN k % 73 = 0 THEN 'not a time' ELSE {LAKE_TIME.format("ts")} END AS event_timestamp,
              order_id, merchant_id, customer_id, service_type, order_status, '1000.00' AS delivery_fee,
              amount_text AS total_amount, {LAKE_TIME.format("eta")} AS estimated_delivery_time, payment_method,
              payment_status, true AS no_items, 'No. ' || (c % 500) || ' Market Street' AS address FROM timed""",
        "silver_scan": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
        "table_counts": f"""{s} SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
            UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events
            UNION ALL SELECT 'supplier', COUNT(*) FROM supplier UNION ALL SELECT 'silver_orders', COUNT(*) FROM silver""",
        "date_spine": f"WITH {DAYS} SELECT day, strftime(day, '%Y/%m/%d') AS folder FROM spine",
        "pending_days": f"""{s} SELECT event_date AS day FROM silver WHERE event_date IS NOT NULL
            GROUP BY 1 HAVING {_count("order_status = 'delivered'")} = 0""",
        "empty_day_guard": f"""{s}, {DAYS} SELECT day, day NOT IN
            (SELECT event_date FROM silver WHERE event_date IS NOT NULL) AS is_empty FROM spine""",
        "parse_timestamps": f"""WITH {FEED} SELECT event_id, ts AS event_time, eta AS promised_time, ts AS iso_time,
            ts IS NULL AS bad_time FROM timed""",
        "cast_money": f"""WITH {FEED} SELECT event_id, CAST(amount AS DOUBLE) AS amount, CAST(1000 AS FLOAT) AS fee,
            COALESCE(amount_text = 'n/a', false) AS bad_amount FROM timed""",
        "parse_json_props": """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props->>'k' AS BIGINT) END AS k,
            event_type = 'error' AS corrupt FROM events""",
        "infer_bronze_schema": """WITH pairs AS (SELECT DISTINCT unnest(json_keys(props)) AS f,
              CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE 'STRING' END AS t FROM events)
            SELECT 'OBJECT<' || string_agg(f || ': ' || t, ', ' ORDER BY f) || '>' AS shape FROM pairs""",
        "infer_message_schema": f"""WITH {COURIERS}, shapes AS (SELECT CAST(json_group_structure(to_json({{
              'battery_level': battery_level, 'courier_id': courier_id, 'current_location':
              {{'address': address, 'latitude': latitude, 'longitude': longitude}},
              'delivery_status': delivery_status, 'event_id': event_id,
              'event_timestamp': strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ'), 'is_online': is_online,
              'merchant_id': merchant_id, 'order_id': order_id, 'vehicle_type': vehicle_type}})) AS VARCHAR) AS js
            FROM couriers WHERE NOT torn)
            SELECT replace(replace(replace(replace(replace(replace(js, '{{', 'OBJECT<'), '}}', '>'), '"', ''), ':', ': '),
              ',', ', '), 'VARCHAR', 'STRING') AS shape FROM shapes""",
        "decode_with_inferred_schema": f"""WITH {COURIERS} SELECT n AS "offset", courier_id, battery_level, is_online,
            latitude FROM couriers WHERE NOT torn""",
        "silver_valid_filter": f"""{s} SELECT event_id, order_id, merchant_id, CAST(amount AS DOUBLE) AS total_amount
            FROM silver""",
        "silver_rejects": f"""WITH {FEED} SELECT event_id, order_id, merchant_id, amount_text AS total_amount,
            CASE WHEN order_id IS NULL THEN 'order_id is null' WHEN merchant_id IS NULL THEN 'merchant_id is null'
              ELSE 'total_amount is no positive number' END AS reason
            FROM timed WHERE order_id IS NULL OR merchant_id IS NULL OR NOT COALESCE(amount > 0, false)""",
        "append_write_roundtrip": f"""{s} SELECT order_id, order_status, CAST(amount AS DOUBLE) AS total_amount, event_date
            FROM silver""",
        "silver_orders": f"{s} SELECT {SILVER_COLUMNS} FROM flagged",
        "order_items": f"""{both} SELECT {', '.join('i.' + c for c in ITEM_COLUMNS.split(', '))}
            FROM items i JOIN silver USING (k)""",
        "preview_items": f"{it} SELECT {ITEM_COLUMNS} FROM items ORDER BY order_id, item_id, quantity, total_price LIMIT 5",
        "line_total": f"{it} SELECT {ITEM_COLUMNS}, unit_price * quantity AS line_total FROM items",
        "order_total_from_items": f"""{it} SELECT order_id, CAST(SUM(total_cents) AS BIGINT) / 100.0 AS items_total
            FROM items GROUP BY 1""",
        "align_to_target": f"""{s} SELECT CAST(amount AS DOUBLE) AS total_amount, order_id, event_date, order_status,
            late AS is_delayed FROM flagged""",
        "order_point_lookup": f"""{s} SELECT order_id, merchant_id, order_status, CAST(amount AS DOUBLE) AS total_amount,
            event_date FROM silver WHERE order_id = '42'""",
        "orders_items_left_join": f"""{both} SELECT s.order_id, order_status, CAST(amount AS DOUBLE) AS total_amount,
            event_date, item_id, name, quantity, unit_price, total_price
            FROM silver s LEFT JOIN items i ON s.order_id = i.order_id""",
        "event_order_lookup": f"""{s}, {COURIERS} SELECT e.order_id, e.event_id, e.courier_id,
            s.merchant_id AS order_merchant_id, s.order_id IS NOT NULL AS matched
            FROM couriers e LEFT JOIN silver s ON e.order_id = s.order_id""",
        "gold_fulfillment": f"{s}, {FULFILLMENT} SELECT * FROM fulfillment",
        "gold_delivery_time": f"{s}, {DELIVERY_TIME} SELECT * FROM delivery_time",
        "gold_eta_accuracy": f"{s}, {ETA} SELECT * FROM eta_accuracy",
        "gold_order_volume": f"{s}, {VOLUME} SELECT * FROM volume",
        "gold_order_volume_joined": f"{s}, {VOLUME} SELECT * FROM volume",
        "gold_order_volume_fanout": f"""{both}, {HOURLY} SELECT f.event_date, COUNT(DISTINCT f.order_id) AS total_orders,
            {_sum(CENTS)} / 100.0 AS total_revenue, {_mean_cents(_sum(CENTS), "COUNT(*)")} AS avg_order_value,
            COUNT(DISTINCT merchant_id) AS active_merchants, COUNT(DISTINCT customer_id) AS active_customers,
            ANY_VALUE(active_hours) AS active_hours, ANY_VALUE(avg_orders_per_hour) AS avg_orders_per_hour
            FROM flagged f LEFT JOIN items i ON f.order_id = i.order_id JOIN spread s ON f.event_date = s.event_date
            GROUP BY f.event_date""",
        "gold_daily_metrics": f"""{s}, {FULFILLMENT}, {DELIVERY_TIME}, {ETA}, {HOURLY},
            money AS (SELECT event_date, {_sum(CENTS)} / 100.0 AS total_revenue,
              {_mean_cents(_sum(CENTS), "COUNT(*)")} AS avg_order_value,
              COUNT(DISTINCT merchant_id) AS active_merchants, COUNT(DISTINCT customer_id) AS active_customers
              FROM flagged GROUP BY 1)
            SELECT f.*, avg_delivery_time, avg_delayed_delivery_time, avg_ontime_delivery_time, total_revenue,
              avg_order_value, active_merchants, active_customers,
              CASE WHEN f.event_date IS NULL THEN 0 ELSE active_hours END AS active_hours,
              CASE WHEN f.event_date IS NOT NULL THEN avg_orders_per_hour END AS avg_orders_per_hour,
              avg_eta_deviation, COALESCE(delayed_deliveries, 0) AS delayed_deliveries,
              e.delay_rate AS delivered_delay_rate
            FROM fulfillment f LEFT JOIN delivery_time d ON f.event_date IS NOT DISTINCT FROM d.event_date
            LEFT JOIN eta_accuracy e ON f.event_date IS NOT DISTINCT FROM e.event_date
            LEFT JOIN spread h ON f.event_date IS NOT DISTINCT FROM h.event_date
            LEFT JOIN money m ON f.event_date IS NOT DISTINCT FROM m.event_date""",
        "hourly_orders": f"{s}, {HOURLY} SELECT * FROM hourly",
        "hourly_distribution": f"{s}, {HOURLY} SELECT * FROM spread",
        "top_days": f"""{s}, {VOLUME} SELECT * FROM volume
            ORDER BY total_orders DESC, total_revenue DESC, event_date LIMIT 10""",
        "courier_timeline": f"""WITH {COURIERS} SELECT courier_id, event_timestamp, n AS event_id, delivery_status,
            ROW_NUMBER() OVER (PARTITION BY courier_id ORDER BY event_timestamp DESC, n DESC) AS position FROM couriers""",
        "courier_current_state": f"""WITH {COURIERS} SELECT courier_id, event_timestamp, n AS event_id, delivery_status,
            is_online FROM couriers
            QUALIFY ROW_NUMBER() OVER (PARTITION BY courier_id ORDER BY event_timestamp DESC, n DESC) = 1""",
        "order_current_state": f"""{s}, {HISTORY} SELECT * FROM history QUALIFY ROW_NUMBER() OVER
            (PARTITION BY order_id ORDER BY event_timestamp DESC NULLS LAST, order_status DESC) = 1""",
        "order_timeline": f"""{s}, {HISTORY} SELECT *, ROW_NUMBER() OVER
            (PARTITION BY order_id ORDER BY event_timestamp DESC, order_status DESC) AS position
            FROM history WHERE event_timestamp IS NOT NULL""",
        "ops_orders_upsert": f"""WITH {MESSAGES} SELECT event_id, ts AS event_timestamp, order_id,
            merchant_id, CAST(NULL AS VARCHAR) AS courier_id, customer_id, service_type, order_status,
            COALESCE(listed, '[]') AS items,
            '{{"latitude":' || CAST((c % 180) - 90 + 0.5::DOUBLE AS VARCHAR) || ',"longitude":'
              || CAST((c % 360) - 180 + 0.25::DOUBLE AS VARCHAR) || ',"address":"No. ' || (c % 500)
              || ' Market Street","floor":' || (c % 40) || '}}' AS delivery_location,
            CAST(1000 AS DOUBLE) AS delivery_fee, CAST(amount AS DOUBLE) AS total_amount,
            eta AS estimated_delivery_time, payment_method, 'completed' AS payment_status, "offset"
            FROM sent WHERE {ORDER_REASON} IS NULL
            QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, ts ORDER BY "offset" DESC) = 1""",
        "ops_orders_rejects": f"""WITH {MESSAGES} SELECT event_id, "offset", {ORDER_REASON} AS reason
            FROM sent WHERE {ORDER_REASON} IS NOT NULL""",
        "ops_courier_upsert": f"""WITH {COURIERS} SELECT event_id, event_timestamp, merchant_id, courier_id, order_id,
            delivery_status, '{{"latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":' || CAST(longitude AS VARCHAR)
              || ',"address":"' || address || '"}}' AS current_location, vehicle_type, is_online, n AS "offset"
            FROM couriers WHERE NOT torn
            QUALIFY ROW_NUMBER() OVER (PARTITION BY courier_id, event_timestamp ORDER BY n DESC) = 1""",
        "merge_orders": f"""{s} SELECT order_id, merchant_id, customer_id,
            CASE WHEN event_date < DATE '1997-01-01' THEN order_status ELSE 'delivered' END AS order_status,
            CAST(amount AS DOUBLE) + CASE WHEN event_date < DATE '1997-01-01' THEN 0 ELSE 100 END AS total_amount,
            event_date FROM silver""",
        "merge_order_items": f"""{it}, target AS (SELECT * FROM items QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, item_id
              ORDER BY name DESC, quantity DESC, unit_price DESC, total_price DESC) = 1),
            kept AS (SELECT * FROM target WHERE quantity >= 20),
            source AS (SELECT * REPLACE (total_price * 2 AS total_price) FROM items WHERE quantity < 30
              QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, item_id
              ORDER BY name DESC, quantity DESC, unit_price DESC, total_price DESC) = 1)
            SELECT COALESCE(s.order_id, t.order_id) AS order_id, COALESCE(s.item_id, t.item_id) AS item_id,
              COALESCE(s.name, t.name) AS name, COALESCE(s.quantity, t.quantity) AS quantity,
              COALESCE(s.unit_price, t.unit_price) AS unit_price, COALESCE(s.total_price, t.total_price) AS total_price
            FROM kept t FULL OUTER JOIN source s ON t.order_id = s.order_id AND t.item_id = s.item_id""",
        "append_union": f"""{s}, o AS (SELECT order_id, order_status, CAST(amount AS DOUBLE) AS total_amount, event_date
            FROM silver) SELECT * FROM o WHERE event_date IS NULL OR event_date < DATE '1998-01-01'
            UNION ALL SELECT * FROM o WHERE event_date >= DATE '1997-01-01'""",
        "dedup_events": "SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events)",
        "publish_envelope": f"""WITH {ROUTED} SELECT topic, key, '{{"event_id":"' || event_id || '","order_id":"' || event_id * 2
            || '","merchant_id":"' || user_id % 100 || '","customer_id":"' || user_id || '"}}' AS value,
            epoch_us(ts) // 1000 AS timestamp_ms FROM records""",
        "route_by_topic": f"""WITH {ROUTED} SELECT topic, CASE topic WHEN 'orders-raw' THEN 'orders'
            WHEN 'couriers-raw' THEN 'couriers' ELSE 'unhandled' END AS handler, COUNT(*) AS records
            FROM records GROUP BY topic""",
        "dead_letter_split": f"""WITH {ROUTED} SELECT topic, key, event_id AS "offset", 'malformed json' AS reason
            FROM records WHERE torn""",
        "bronze_path": f"""WITH {ROUTED} SELECT 'bronze/delivery/' || replace(topic, '-', '/') || '/'
            || strftime(landed, '%Y/%m/%d/%H/%M%S') || '.parquet' AS path, COUNT(*) AS records FROM routed GROUP BY 1""",
        "merchant_csv_clean": """SELECT s_name AS "Name", 'Lot ' || s_suppkey || ', District ' || s_nationkey AS "Address"
            FROM supplier""",
        "silver_write_roundtrip": f"{s} SELECT {SILVER_COLUMNS} FROM flagged",
        "items_write_roundtrip": f"""{both} SELECT {', '.join('i.' + c for c in ITEM_COLUMNS.split(', '))}, event_date
            FROM items i JOIN silver USING (k)""",
        "gold_write_roundtrip": f"{s}, {FULFILLMENT} SELECT * FROM fulfillment",
        "stream_source_json": f"""WITH {ROUTED} SELECT topic, key, event_id AS "offset",
            CASE WHEN topic <> 'reviews-raw' THEN CAST(event_id AS VARCHAR) END AS event_id,
            CAST(event_id * 2 AS VARCHAR) AS order_id, ts AS event_time FROM records WHERE NOT torn""",
        "stream_to_bronze": f"""WITH {ROUTED} SELECT topic, CAST(landed AS DATE) AS ingest_date,
            CAST(hour(landed) AS INTEGER) AS ingest_hour, key, event_id AS "offset" FROM records""",
        "stream_to_bronze_typed": f"""WITH {ROUTED} SELECT event_id + d * 1000000000000 AS "offset",
            CAST(landed AS DATE) AS ingest_date,
            CASE WHEN NOT torn THEN CAST(event_id AS VARCHAR) END AS event_id,
            CASE WHEN NOT torn THEN CAST(user_id % 100 AS VARCHAR) END AS merchant_id,
            CASE WHEN NOT torn AND event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS courier_id,
            CASE WHEN NOT torn THEN CAST(event_id * 2 AS VARCHAR) END AS order_id,
            CASE WHEN NOT torn THEN 10.5::DOUBLE END AS latitude,
            CASE WHEN NOT torn AND d = 1 THEN 3::BIGINT END AS floor,
            CASE WHEN NOT torn AND d = 0 THEN true END AS is_online,
            CASE WHEN NOT torn AND d = 1 THEN 'app' END AS channel,
            CASE WHEN torn THEN 'value' WHEN d = 1 THEN 'is_online' ELSE '' END AS rescued_fields,
            CASE WHEN NOT torn AND d = 1 THEN '"yes"' END AS rescued_online
            FROM routed, (VALUES (0), (1)) v(d) WHERE topic = 'couriers-raw'""",
        "stream_dedup": f"""WITH {ROUTED} SELECT topic, CASE WHEN topic = 'reviews-raw' THEN 'r' ELSE '' END || event_id
            AS message_id, key, event_id AS "offset" FROM records WHERE NOT torn""",
        "stream_upsert_state": f"""WITH {COURIERS} SELECT event_id, event_timestamp, merchant_id, courier_id, order_id,
            delivery_status, vehicle_type, true AS is_online FROM couriers WHERE NOT torn
            QUALIFY ROW_NUMBER() OVER (PARTITION BY courier_id, event_timestamp ORDER BY n DESC) = 1""",
        "state_point_lookup": f"""WITH {COURIERS} SELECT event_id, event_timestamp, merchant_id, courier_id, order_id,
            delivery_status, vehicle_type, true AS is_online FROM couriers
            WHERE NOT torn AND courier_id = (SELECT CAST(MIN(user_id) AS VARCHAR) FROM events)
            QUALIFY ROW_NUMBER() OVER (PARTITION BY courier_id, event_timestamp ORDER BY n DESC) = 1""",
        "stream_daily_counts": f"""{s} SELECT event_date, COUNT(*) AS total_orders,
            {_count("order_status = 'delivered'")} AS delivered_orders,
            {_count("order_status = 'cancelled'")} AS cancelled_orders FROM silver GROUP BY 1""",
        "dq_nulls": f"WITH {FEED} "
        + _checks(
            "timed",
            [
                (f"{n} is null", f"{c} IS NULL")
                for n, c in (
                    ("event_id", "event_id"),
                    ("order_id", "order_id"),
                    ("merchant_id", "merchant_id"),
                    ("total_amount", "amount_text"),
                    ("estimated_delivery_time", "eta"),
                )
            ],
        ),
        "dq_times": f"WITH {FEED} "
        + _checks("timed", [("event_timestamp unreadable", "ts IS NULL"), ("estimated_delivery_time unreadable", "false")]),
        "dq_amounts": f"WITH {FEED} "
        + _checks("timed", [("total_amount <= 0", "amount <= 0"), ("total_amount not a number", "amount_text = 'n/a'")]),
        "dq_schema": f"{s} "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", '{t}' AS expected_type, '{t}' AS actual_type, true AS matches, "
            f"COUNT(*) AS rows, {_count(c + ' IS NULL')} AS nulls FROM flagged"
            for n, t, c in SCHEMA_ROWS
        ),
        "dq_delay_rule": f"{s} "
        + _checks("flagged", [("delay rule broken", "late <> COALESCE(minutes > 45, false)"), ("delayed", "late")]),
        "dq_domains": f"WITH {FEED} "
        + " UNION ALL ".join(
            [
                _domain("timed", "service_type", "true"),
                _domain("timed", "order_status", "true"),
                _domain("timed", "payment_method", "payment_method <> 'voucher'"),
                _domain("timed", "payment_status", "true"),
            ]
        ),
        "dq_courier_domains": f"""WITH {COURIERS}, checked AS (SELECT delivery_status,
            CASE WHEN n % 11 = 0 THEN 'Sled' ELSE vehicle_type END AS vehicle_type FROM couriers) """
        + _domain("checked", "delivery_status", "delivery_status IN ('assigned', 'accepted', 'picked_up', 'delivered', 'cancelled')")
        + " UNION ALL "
        + _domain("checked", "vehicle_type", "vehicle_type <> 'Sled'"),
        "dq_order_totals": f"""{both}, sums AS (SELECT order_id, SUM(total_cents) AS cents FROM items GROUP BY 1)
            SELECT s.order_id, CAST(amount AS DOUBLE) AS total_amount, CAST(cents AS BIGINT) / 100.0 AS items_total
            FROM silver s JOIN sums u ON s.order_id = u.order_id WHERE CAST(amount * 100 AS BIGINT) <> cents""",
        "dq_ratings": f"""WITH {ROUTED}, rated AS (SELECT event_id % 5 + 1 AS courier_rating, event_id % 7 AS merchant_rating,
            event_id % 4 + 1 AS delivery_rating FROM records WHERE topic = 'reviews-raw') """
        + " UNION ALL ".join(_domain("rated", f"{w}_rating", f"{w}_rating BETWEEN 1 AND 5") for w in ("courier", "merchant", "delivery")),
        "dq_item_totals": f"""{it} SELECT order_id, item_id, CAST(quantity AS BIGINT) AS quantity, unit_price, total_price
            FROM items WHERE unit_cents * quantity <> total_cents""",
        "dq_missing_feeds": f"""WITH {ROUTED}, present AS (SELECT DISTINCT date_trunc('hour', ts) AS hour, topic FROM records
            WHERE NOT torn), wanted AS (SELECT hour, feed FROM
            (SELECT unnest(generate_series(MIN(hour), MAX(hour), INTERVAL 1 HOUR)) AS hour FROM present),
            (VALUES ('orders-raw'), ('couriers-raw'), ('merchants-raw'), ('reviews-raw')) v(feed))
            SELECT hour, feed FROM wanted EXCEPT SELECT hour, topic FROM present""",
        "dq_freshness_volume": f"""{s} SELECT event_date, COUNT(*) AS orders, MAX(ts) AS newest_event, COUNT(*) >= 5 AS enough
            FROM silver GROUP BY 1""",
        "dq_gate_report": f"{both}, {FULFILLMENT} "
        + " UNION ALL ".join(
            [
                _checks("flagged", CHECKS_SILVER, "silver_orders"),
                _checks("items", CHECKS_ITEMS, "silver_items"),
                _checks("fulfillment", CHECKS_GOLD, "gold"),
            ]
        ),
    }
    q["merge_orders_stored"] = q["merge_orders"]
    return q
