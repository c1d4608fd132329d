"""DuckDB SQL equivalent of every registered query that SQL can express.

The domain derivations of ``sources.domain`` are restated here as CTEs so
the oracle reads the same parquet tables independently of Spark.
"""

from __future__ import annotations

from ledgerline import config
from ledgerline.plans import catalog as C
from ledgerline.operators.commands import COMMAND_OF_EVENT
from ledgerline.schemas import ORDER_COMMAND_RESULT_DDL, STOCK_RESULT_DDL
from ledgerline.sources import domain as D
from ledgerline.sources import topics as TP

MONEY = "DECIMAL(19,4)"


def ts(d) -> str:
    return f"TIMESTAMP '{d.strftime('%Y-%m-%d %H:%M:%S')}'"


def r4(expr: str) -> str:
    """Exact decimal → double, as ``present`` does on the Spark side."""
    return f"CAST({expr} AS DOUBLE)"


def _case(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


TOPIC = _case("event_type", config.EVENT_TYPE_TOPIC, "event_type")
STATUS = _case(f"({TOPIC})", config.TOPIC_STATUS, f"({TOPIC})")

CTE_METRIC_EVENTS = f"""metric_events AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
         CAST(value AS {MONEY}) AS total_amount, {STATUS} AS status, {TOPIC} AS topic,
         ts AS event_time, json_extract_string(props, '$.k') AS product_id
  FROM events)"""

CTE_METRIC_ITEMS = """metric_items AS (
  SELECT event_time, product_id, 1 AS quantity, total_amount AS unit_price
  FROM metric_events WHERE topic = 'order.created')"""

CTE_ORDER_LINES = f"""order_lines AS (
  SELECT l_orderkey AS order_key, CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_no,
         CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS {MONEY}) AS unit_price,
         CAST(CAST(p_retailprice AS {MONEY}) * CAST(l_quantity AS INTEGER) AS {MONEY}) AS line_total
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CTE_ORDER_TOTALS = f"""order_totals AS (
  SELECT order_key, CAST(SUM(line_total) AS {MONEY}) AS total_amount, COUNT(*) AS n_lines
  FROM order_lines GROUP BY order_key)"""

_CARRIER = _case("o_orderpriority", D.CARRIER_BY_PRIORITY, f"'{D.DEFAULT_CARRIER}'")
CTE_JOURNAL = f"""hdr AS (
  SELECT o_orderkey AS order_key, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, o_orderdate AS created_at,
         o_orderstatus, o_orderpriority, t.total_amount, t.n_lines,
         CASE WHEN t.n_lines IS NOT NULL THEN CAST(o_custkey AS VARCHAR) END AS cid, t.n_lines IS NOT NULL AS made
  FROM orders LEFT JOIN order_totals t ON t.order_key = o_orderkey),
journal AS (
  SELECT order_id, order_key, CAST(0 AS BIGINT) AS seq, 'OrderCreated' AS event_type, created_at AS ts,
         customer_id, total_amount, NULL::VARCHAR AS tracking_number, NULL::VARCHAR AS carrier, NULL::VARCHAR AS reason,
         cid, made
  FROM hdr WHERE n_lines IS NOT NULL
  UNION ALL
  SELECT order_id, order_key, 1, 'OrderConfirmed', created_at + INTERVAL 1 DAY, NULL, NULL, NULL, NULL, NULL, cid, made
  FROM hdr WHERE o_orderstatus IN ('P', 'F')
  UNION ALL
  SELECT order_id, order_key, 1, 'OrderCancelled', created_at + INTERVAL 1 DAY, NULL, NULL, NULL, NULL, '{D.CANCEL_REASON_EARLY}', cid, made
  FROM hdr WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
  UNION ALL
  SELECT order_id, order_key, 2, 'OrderShipped', created_at + INTERVAL 2 DAY, NULL, NULL, '{D.TRACKING_PREFIX}' || order_id, {_CARRIER}, NULL, cid, made
  FROM hdr WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT order_id, order_key, 3, 'OrderDelivered', created_at + INTERVAL 5 DAY, NULL, NULL, NULL, NULL, NULL, cid, made
  FROM hdr WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT order_id, order_key, 3, 'OrderCancelled', created_at + INTERVAL 3 DAY, NULL, NULL, NULL, NULL, '{D.CANCEL_REASON_LATE}', cid, made
  FROM hdr WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def hourly_metrics_sql(source: str, where: str = "TRUE") -> str:
    return f"""SELECT window_start, window_end, COUNT(*) AS order_count,
       {r4('SUM(total_amount)')} AS total_revenue,
       CASE WHEN COUNT(*) > 0 THEN CAST(SUM(total_amount) AS DOUBLE) / COUNT(*) ELSE 0.0 END
         AS avg_order_value
FROM (SELECT date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL {config.WINDOW_SECONDS} SECOND AS window_end,
             total_amount FROM {source} WHERE {where}) w
GROUP BY window_start, window_end"""


def product_rows_sql(source: str) -> str:
    return f"""SELECT window_start, window_end, product_id,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
       {r4('SUM(CAST(unit_price * quantity AS ' + MONEY + '))')} AS total_revenue
FROM (SELECT date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL {config.WINDOW_SECONDS} SECOND AS window_end,
             product_id, quantity, unit_price FROM {source}) w
GROUP BY window_start, window_end, product_id"""


def contained_sql(frm, to) -> str:
    return f"window_start >= {ts(frm)} AND window_end <= {ts(to)}"


def revenue_summary_sql(frm, to) -> str:
    return with_ctes(CTE_METRIC_EVENTS, f"hm AS ({hourly_metrics_raw_sql()})") + f"""
SELECT {ts(frm)} AS range_from, {ts(to)} AS range_to,
       {r4('COALESCE(SUM(total_revenue), 0)')} AS total_revenue,
       CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS order_count,
       CASE WHEN COALESCE(SUM(order_count), 0) > 0
            THEN CAST(SUM(total_revenue) AS DOUBLE) / SUM(order_count) ELSE 0.0 END AS avg_order_value
FROM hm WHERE {contained_sql(frm, to)}"""


def hourly_metrics_raw_sql() -> str:
    """Window totals with the exact decimal revenue (for range sums)."""
    return f"""SELECT window_start, window_end, COUNT(*) AS order_count, SUM(total_amount) AS total_revenue
FROM (SELECT date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL {config.WINDOW_SECONDS} SECOND AS window_end,
             total_amount FROM metric_events) w
GROUP BY window_start, window_end"""


def top_products_sql(items_ctes: list[str], source: str, frm, to, limit: int) -> str:
    return with_ctes(*items_ctes, f"pr AS ({product_rows_sql(source)})") + f"""
SELECT * FROM pr WHERE {contained_sql(frm, to)}
ORDER BY total_revenue DESC, product_id ASC, window_start ASC LIMIT {limit}"""


ORDER_ITEMS_FROM_JOURNAL = """created_items AS (
  SELECT j.ts AS event_time, l.product_id, l.quantity, l.unit_price
  FROM order_lines l JOIN journal j ON j.order_key = l.order_key AND j.event_type = 'OrderCreated')"""

SQL: dict[str, str] = {
    "a1_hourly_metrics": with_ctes(CTE_METRIC_EVENTS) + hourly_metrics_sql("metric_events"),
    "a1_hourly_metrics_created": with_ctes(CTE_METRIC_EVENTS)
    + hourly_metrics_sql("metric_events", "status = 'created'"),
    "a4_top_product_rows": with_ctes(CTE_METRIC_EVENTS, CTE_METRIC_ITEMS) + product_rows_sql("metric_items"),
    "a4_top_product_rows_exploded": with_ctes(CTE_METRIC_EVENTS, CTE_METRIC_ITEMS)
    + product_rows_sql("metric_items"),
    "t2_hourly_series": with_ctes(CTE_METRIC_EVENTS, f"hm AS ({hourly_metrics_sql('metric_events')})")
    + f"SELECT * FROM hm WHERE {contained_sql(C.EVENTS_FROM, C.EVENTS_TO)} ORDER BY window_start",
    "a6_revenue_summary": revenue_summary_sql(C.EVENTS_FROM, C.EVENTS_TO),
    "a6_revenue_summary_empty": revenue_summary_sql(C.EMPTY_FROM, C.EMPTY_TO),
    "t1_top_products": top_products_sql([CTE_METRIC_EVENTS, CTE_METRIC_ITEMS], "metric_items",
                                        C.EVENTS_FROM, C.EVENTS_TO, config.TOP_PRODUCTS_LIMIT),
    "a4_order_product_rows": with_ctes(CTE_ORDER_LINES, CTE_ORDER_TOTALS, CTE_JOURNAL, ORDER_ITEMS_FROM_JOURNAL)
    + product_rows_sql("created_items"),
    "t1_top_order_products": top_products_sql(
        [CTE_ORDER_LINES, CTE_ORDER_TOTALS, CTE_JOURNAL, ORDER_ITEMS_FROM_JOURNAL], "created_items",
        C.ORDERS_FROM, C.ORDERS_TO, 25),
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --------------------------------------------------------------------------- orders
ORDER_CTES = [CTE_ORDER_LINES, CTE_ORDER_TOTALS, CTE_JOURNAL]
STATUS_OF = ("CASE event_type WHEN 'OrderCreated' THEN 'PENDING' WHEN 'OrderConfirmed' THEN 'CONFIRMED' "
             "WHEN 'OrderShipped' THEN 'SHIPPED' WHEN 'OrderDelivered' THEN 'DELIVERED' "
             "WHEN 'OrderCancelled' THEN 'CANCELLED' END")
JOURNAL_COLS = ("order_id, seq, event_type, ts, customer_id, " + r4("total_amount") +
                " AS total_amount, tracking_number, carrier, reason")


def replay_sql(where: str = "TRUE") -> str:
    return f"""SELECT order_id, arg_max({STATUS_OF}, seq) AS status, max(seq) AS last_seq,
       arg_max(ts, seq) AS updated_at,
       arg_max(customer_id, seq) FILTER (WHERE event_type = 'OrderCreated') AS customer_id,
       arg_max(total_amount, seq) FILTER (WHERE event_type = 'OrderCreated') AS total_amount,
       arg_max(ts, seq) FILTER (WHERE event_type = 'OrderCreated') AS created_at,
       arg_max(tracking_number, seq) FILTER (WHERE event_type = 'OrderShipped') AS tracking_number,
       arg_max(carrier, seq) FILTER (WHERE event_type = 'OrderShipped') AS carrier
FROM journal WHERE {where} GROUP BY order_id
HAVING bool_or(event_type = 'OrderCreated')"""


def _jstr(x: str) -> str:
    return f"""COALESCE('"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"', 'null')"""


CTE_CREATED_DOC = f"""items_doc AS (
  SELECT order_id, '[' || string_agg('{{"productId":' || {_jstr('product_id')} || ',"productName":'
         || {_jstr('product_name')} || ',"quantity":' || CAST(quantity AS VARCHAR) || ',"unitPrice":'
         || CAST(unit_price AS VARCHAR) || '}}', ',' ORDER BY line_no, product_id, product_name, quantity, unit_price) || ']' AS items_json
  FROM order_lines GROUP BY order_id),
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         'Street ' || CAST(c_custkey AS VARCHAR) || ', nation ' || CAST(c_nationkey AS VARCHAR) AS shipping_address
  FROM customer),
created_doc AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, COALESCE(d.items_json, '[]') AS items_json, c.shipping_address
  FROM orders LEFT JOIN items_doc d ON d.order_id = CAST(o_orderkey AS VARCHAR)
  LEFT JOIN cust c ON c.customer_id = CAST(o_custkey AS VARCHAR))"""

CTE_SUMMARY = f"""state AS ({replay_sql()}),
summary AS (
  SELECT s.order_id, s.customer_id, s.status, s.total_amount, s.tracking_number, s.carrier,
         s.created_at, s.updated_at, s.last_seq, d.items_json, d.shipping_address
  FROM state s LEFT JOIN created_doc d ON d.order_id = s.order_id)"""

SUMMARY_COLS = ("order_id, customer_id, status, " + r4("total_amount") + " AS total_amount, tracking_number, "
                "carrier, created_at, updated_at, last_seq, items_json, shipping_address")

LEGAL_SQL = "['>PENDING', 'PENDING>CONFIRMED', 'CONFIRMED>SHIPPED', 'SHIPPED>DELIVERED', " \
            "'PENDING>CANCELLED', 'CONFIRMED>CANCELLED']"

CTE_ENRICHED = """enriched AS (
  SELECT j.order_id, c.customer_id, c.total_amount,
         lower(regexp_replace(j.event_type, '^Order', '')) AS status, j.ts AS event_time
  FROM journal j JOIN (SELECT order_id, customer_id, total_amount FROM journal
                       WHERE event_type = 'OrderCreated') c ON c.order_id = j.order_id)"""

SQL.update({
    "s4_order_journal": with_ctes(*ORDER_CTES) + f"SELECT {JOURNAL_COLS} FROM journal",
    "s4_journal_audit": with_ctes(*ORDER_CTES) + f"""SELECT order_id, position, seq,
       CASE WHEN seq <= high THEN 'repeat' ELSE 'gap' END AS finding,
       CASE WHEN seq > high THEN high + 1 END AS from_seq, CASE WHEN seq > high THEN seq - 1 END AS to_seq
FROM (SELECT *, COALESCE(max(seq) OVER (PARTITION BY order_id ORDER BY position
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS high
      FROM (SELECT j.order_id, seq, row_number() OVER (ORDER BY ts, order_key, seq, copy) - 1 AS position
            FROM journal j JOIN orders ON o_orderkey = order_key, range(0, 2) c(copy)
            WHERE NOT (o_orderpriority = '{C.LOST_PRIORITY}' AND seq = 1)
              AND (copy = 0 OR (o_orderpriority = '{C.TWICE_PRIORITY}' AND seq = 0))) p) h
WHERE seq <= high OR seq > high + 1""",
    "w1_replay_order_state": with_ctes(*ORDER_CTES) + f"""SELECT order_id, status, last_seq, updated_at,
       customer_id, {r4('total_amount')} AS total_amount, created_at, tracking_number, carrier
FROM ({replay_sql()}) s""",
    "w2_state_at": with_ctes(*ORDER_CTES) + f"""SELECT order_id, status, last_seq, updated_at,
       customer_id, {r4('total_amount')} AS total_amount, created_at, tracking_number, carrier
FROM ({replay_sql(f"ts <= {ts(C.AS_OF)}")}) s""",
    "w3_illegal_transitions": with_ctes(*ORDER_CTES) + f"""SELECT order_id, seq, event_type, ts, from_status, to_status
FROM (SELECT order_id, seq, event_type, ts, {STATUS_OF} AS to_status,
             CASE WHEN lag(seq) OVER w = seq - 1 THEN lag({STATUS_OF}) OVER w END AS from_status
      FROM journal WINDOW w AS (PARTITION BY order_id ORDER BY seq)) c
WHERE NOT list_contains({LEGAL_SQL}, COALESCE(from_status, '') || '>' || to_status)""",
    "k11_order_summary": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, CTE_SUMMARY) + f"SELECT {SUMMARY_COLS} FROM summary",
    "p14_orders_by_status": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, CTE_SUMMARY)
    + f"SELECT {SUMMARY_COLS} FROM summary WHERE status = 'DELIVERED'",
    "t3_list_orders": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, CTE_SUMMARY)
    + f"""SELECT {SUMMARY_COLS} FROM summary WHERE status = '{C.LIST_STATUS}'
ORDER BY created_at DESC, order_id DESC LIMIT {C.LIST_SIZE} OFFSET {C.LIST_PAGE * C.LIST_SIZE}""",
    "t3_list_orders_customer": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, CTE_SUMMARY)
    + f"""SELECT {SUMMARY_COLS} FROM summary WHERE customer_id = '{C.LIST_CUSTOMER}'
ORDER BY created_at DESC, order_id DESC LIMIT {config.PAGE_SIZE} OFFSET 0""",
    "p15_find_order": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, CTE_SUMMARY)
    + f"SELECT {SUMMARY_COLS} FROM summary WHERE order_id = '{C.FIND_ORDER_ID}'",
    "j5_orphan_status_events": with_ctes(*ORDER_CTES) + f"""SELECT {JOURNAL_COLS} FROM journal j
WHERE event_type <> 'OrderCreated' AND NOT made""",
    "j5_status_updates": with_ctes(*ORDER_CTES) + f"""SELECT {JOURNAL_COLS} FROM journal j
WHERE event_type <> 'OrderCreated' AND made""",
    "a1_order_hourly_metrics": with_ctes(*ORDER_CTES, CTE_ENRICHED) + hourly_metrics_sql("enriched"),
    "a1_order_hourly_metrics_created": with_ctes(*ORDER_CTES, CTE_ENRICHED)
    + hourly_metrics_sql("enriched", "status = 'created'"),
})


# --------------------------------------------------------------------------- inventory
CTE_CREATED_LINES = f"""stock_initial AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CAST(p_size * {config.STOCK_PER_SIZE_UNIT} AS INTEGER) AS available FROM part),
created_lines AS (
  SELECT l.order_key, l.order_id, l.line_no, l.product_id, l.quantity, o_orderdate AS created_at,
         o_orderstatus, o_orderpriority, CAST(l.order_key AS BIGINT) AS seq
  FROM order_lines l JOIN orders ON o_orderkey = l.order_key)"""

CTE_STOCK_LEDGER = """first_lines AS (
  SELECT order_key, order_id, product_id,
         arg_min(quantity, (line_no, quantity)) AS quantity, min(line_no) AS line_no,
         any_value(created_at) AS created_at, any_value(o_orderstatus) AS st, any_value(o_orderpriority) AS pr
  FROM created_lines GROUP BY order_key, order_id, product_id),
ledger AS (
  SELECT product_id, 'StockReplenished' AS event_type, NULL::VARCHAR AS order_id, available AS quantity,
         TIMESTAMP '1990-01-01 00:00:00' AS ts, CAST(-1 AS BIGINT) AS seq FROM stock_initial
  UNION ALL
  SELECT product_id, 'StockReserved', order_id, quantity, created_at, order_key FROM first_lines
  UNION ALL
  SELECT product_id, 'ReservationConfirmed', order_id, quantity, created_at + INTERVAL 1 DAY, order_key
  FROM first_lines WHERE st IN ('P', 'F')
  UNION ALL
  SELECT product_id, 'ReservationReleased', order_id, quantity, created_at + INTERVAL 1 DAY, order_key
  FROM first_lines WHERE st = 'O' AND pr = '5-LOW'),
open_res AS (
  SELECT product_id, order_id, arg_max(quantity, (ts, seq)) AS quantity
  FROM ledger WHERE order_id IS NOT NULL GROUP BY product_id, order_id
  HAVING arg_max(event_type, (ts, seq)) = 'StockReserved'),
levels AS (
  SELECT a.product_id, a.available, COALESCE(h.reserved, 0) AS reserved,
         CAST(a.available + COALESCE(h.reserved, 0) AS BIGINT) AS total,
         COALESCE(h.open_reservations, 0) AS open_reservations
  FROM (SELECT product_id, CAST(SUM(CASE WHEN event_type IN ('StockReplenished', 'ReservationReleased') THEN quantity
                                          WHEN event_type = 'StockReserved' THEN -quantity ELSE 0 END) AS BIGINT) AS available
        FROM ledger GROUP BY product_id) a
  LEFT JOIN (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS reserved, COUNT(*) AS open_reservations
             FROM open_res GROUP BY product_id) h ON h.product_id = a.product_id)"""

CTE_ITEM_RESULTS = """item_results AS (
  SELECT l.order_id, l.line_no, l.product_id, l.quantity, l.created_at AS ts, l.seq,
         (l.quantity > 0 AND l.quantity <= COALESCE(s.available, 0)) AS ok,
         CASE WHEN l.quantity <= 0 THEN 'Quantity must be positive, got ' || CAST(l.quantity AS VARCHAR)
              WHEN NOT (l.quantity <= COALESCE(s.available, 0))
              THEN 'Insufficient stock for ' || l.product_id || ': available=' || CAST(COALESCE(s.available, 0) AS VARCHAR)
                   || ', requested=' || CAST(l.quantity AS VARCHAR) END AS message
  FROM created_lines l LEFT JOIN stock_initial s ON s.product_id = l.product_id),
outcome AS (
  SELECT order_id, bool_and(ok) AS reserved, COUNT(*) AS n_items,
         CAST(SUM(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS n_failed,
         CASE WHEN SUM(CASE WHEN ok THEN 0 ELSE 1 END) > 0 THEN 'Insufficient stock: ' ||
           string_agg(CASE WHEN NOT ok THEN product_id || ': ' || message END, ', '
                      ORDER BY line_no, product_id, message) END AS reason
  FROM item_results GROUP BY order_id)"""

INV_CTES = [CTE_ORDER_LINES, CTE_CREATED_LINES]
SQL.update({
    "k1_stock_levels": with_ctes(*INV_CTES, CTE_STOCK_LEDGER) + "SELECT * FROM levels",
    "k1_open_reservations": with_ctes(*INV_CTES, CTE_STOCK_LEDGER) + "SELECT * FROM open_res",
    "k6_inventory_snapshot": with_ctes(*INV_CTES, CTE_STOCK_LEDGER)
    + "SELECT v.*, s.product_name FROM levels v LEFT JOIN stock_initial s ON s.product_id = v.product_id",
    "j3_order_reservation_outcome": with_ctes(*INV_CTES, CTE_ITEM_RESULTS) + "SELECT * FROM outcome",
    "a9_failure_reasons": with_ctes(*INV_CTES, CTE_ITEM_RESULTS)
    + "SELECT order_id, reason FROM outcome WHERE NOT reserved",
    "j4_compensation_set": with_ctes(*INV_CTES, CTE_ITEM_RESULTS) + """SELECT i.order_id, i.line_no, i.product_id,
       i.quantity FROM item_results i JOIN outcome o ON o.order_id = i.order_id WHERE i.ok AND NOT o.reserved""",
})


# --------------------------------------------------------------------------- saga
SAGA_CTES = [CTE_ORDER_LINES, CTE_ORDER_TOTALS, CTE_JOURNAL, CTE_CREATED_LINES, CTE_ITEM_RESULTS]
CTE_SAGA = f"""created AS (
  SELECT order_id, ts, customer_id, total_amount FROM journal WHERE event_type = 'OrderCreated'),
inv AS (
  SELECT o.order_id, o.reserved, o.reason, c.ts + INTERVAL 1 MINUTE AS ts, c.customer_id
  FROM outcome o JOIN created c ON c.order_id = o.order_id),
acct AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_acctbal AS acctbal FROM customer),
pay AS (
  SELECT i.order_id, i.ts + INTERVAL 1 MINUTE AS ts, a.acctbal
  FROM inv i LEFT JOIN acct a ON a.customer_id = i.customer_id WHERE i.reserved),
saga AS (
  SELECT c.order_id, c.ts AS created_at, c.customer_id, c.total_amount,
         CASE WHEN i.reserved THEN i.ts END AS inventory_reserved_at,
         CASE WHEN NOT i.reserved THEN i.ts END AS inventory_failed_at,
         CASE WHEN NOT i.reserved THEN i.reason END AS inventory_reason,
         CASE WHEN p.acctbal >= 0 THEN p.ts END AS paid_at,
         CASE WHEN p.order_id IS NOT NULL AND (p.acctbal IS NULL OR NOT (p.acctbal >= 0)) THEN p.ts END AS payment_failed_at,
         CASE WHEN p.order_id IS NOT NULL AND (p.acctbal IS NULL OR NOT (p.acctbal >= 0))
              THEN '{C.PAYMENT_DECLINED}' END AS payment_reason,
         'inv-' || c.order_id AS inventory_id,
         CASE WHEN i.reserved THEN 'pay-' || c.order_id END AS payment_id
  FROM created c LEFT JOIN inv i ON i.order_id = c.order_id LEFT JOIN pay p ON p.order_id = c.order_id),
flags AS (
  SELECT *, inventory_failed_at IS NOT NULL AS inv_failed,
         inventory_reserved_at IS NOT NULL AND inventory_failed_at IS NULL AS reserved_ok,
         inventory_reserved_at IS NOT NULL AND inventory_failed_at IS NULL AND paid_at IS NOT NULL AS paid_ok,
         inventory_reserved_at IS NOT NULL AND inventory_failed_at IS NULL AND paid_at IS NULL
           AND payment_failed_at IS NOT NULL AS pay_failed
  FROM saga),
st AS (
  SELECT order_id, customer_id, total_amount, inventory_id, payment_id,
         CASE WHEN inv_failed THEN 'cancelled' WHEN paid_ok THEN 'completed' WHEN pay_failed THEN 'cancelled'
              WHEN reserved_ok THEN 'awaiting_payment' ELSE 'awaiting_inventory' END AS saga_status,
         (inv_failed OR paid_ok OR pay_failed) AS ended, pay_failed AS stock_released,
         CASE WHEN inv_failed THEN '{config.INVENTORY_FAILED_PREFIX}' || inventory_reason
              WHEN pay_failed THEN '{config.PAYMENT_FAILED_PREFIX}' || payment_reason END AS cancel_reason
  FROM flags)"""

SQL.update({
    "j2_saga_correlate": with_ctes(*SAGA_CTES, CTE_SAGA) + f"""SELECT order_id, created_at, customer_id,
       {r4('total_amount')} AS total_amount, inventory_reserved_at, inventory_failed_at, inventory_reason, paid_at,
       payment_failed_at, payment_reason, inventory_id, payment_id FROM saga""",
    "k12_saga_status": with_ctes(*SAGA_CTES, CTE_SAGA) + f"""SELECT order_id, customer_id,
       {r4('total_amount')} AS total_amount, inventory_id, payment_id, saga_status, ended, stock_released,
       cancel_reason FROM st""",
    "k13_saga_commands": with_ctes(*SAGA_CTES, CTE_SAGA) + f"""SELECT order_id, step, command, target_id,
       {r4('amount')} AS amount, reason FROM (
  SELECT order_id, 1 AS step, 'ReserveInventory' AS command, inventory_id AS target_id,
         NULL::DECIMAL(19,4) AS amount, NULL::VARCHAR AS reason FROM st
  UNION ALL SELECT order_id, 2, 'ProcessPayment', payment_id, total_amount, NULL FROM st WHERE payment_id IS NOT NULL
  UNION ALL SELECT order_id, 3, 'ConfirmOrder', order_id, NULL, NULL FROM st WHERE saga_status = 'completed'
  UNION ALL SELECT order_id, 2, 'CancelOrder', order_id, NULL, cancel_reason FROM st
            WHERE saga_status = 'cancelled' AND NOT stock_released
  UNION ALL SELECT order_id, 3, 'CancelInventoryReservation', inventory_id, NULL, cancel_reason FROM st
            WHERE stock_released
  UNION ALL SELECT order_id, 4, 'CancelOrder', order_id, NULL, cancel_reason FROM st WHERE stock_released) x""",
})

# --------------------------------------------------------------------------- order ⟕ stock
CTE_DOCS = """docs AS (
  SELECT order_id, '{"orderId":"' || order_id || '","items":' || items_json || '}' AS doc FROM created_doc),
doc_skus AS (
  SELECT order_id, l, i FROM (
    SELECT order_id, json_extract_string(doc, '$.items[*].productId') AS l FROM docs) d,
    LATERAL (SELECT unnest(range(1, len(d.l) + 1)) AS i) r),
skus AS (
  SELECT order_id, CAST(i - 1 AS INTEGER) AS pos, l[i] AS sku FROM doc_skus
  WHERE l[i] IS NOT NULL AND trim(l[i]) <> '')"""
DOC_CTES = [*ORDER_CTES, CTE_CREATED_DOC, CTE_DOCS]
A8_SQL = """SELECT d.order_id, lower(s.sku) AS sku_key, arg_min(s.sku, s.pos) AS sku
FROM docs d LEFT JOIN skus s ON s.order_id = d.order_id GROUP BY d.order_id, lower(s.sku)"""

SQL.update({
    "p13_extract_skus": with_ctes(*DOC_CTES) + "SELECT order_id, pos, sku FROM skus",
    "a8_distinct_skus": with_ctes(*DOC_CTES) + A8_SQL,
    "j1_order_with_stock": with_ctes(*DOC_CTES, CTE_CREATED_LINES, CTE_STOCK_LEDGER) + f"""
SELECT d.order_id, d.sku, v.available, v.reserved, v.total,
       CASE WHEN d.sku IS NULL THEN NULL WHEN v.available IS NULL THEN 404 ELSE 200 END AS stock_status
FROM ({A8_SQL}) d LEFT JOIN levels v ON lower(v.product_id) = d.sku_key""",
})

# --------------------------------------------------------------------------- notifications
CTE_NOTIFY = """cust_x AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cid, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'https://hooks.example.com/customers/' || CAST(c_custkey AS VARCHAR) END
           AS webhook_url FROM customer),
nevents AS (
  SELECT j.event_type, j.order_id, cu.email AS customer_email,
         upper(regexp_replace(j.event_type, '^Order', '')) AS status, j.tracking_number,
         j.reason AS cancellation_reason, cu.webhook_url, j.ts
  FROM journal j LEFT JOIN cust_x cu ON cu.cid = j.cid)"""


def _n1(default: bool) -> str:
    subj = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in config.NOTIFY_TEMPLATES.items())

    def body_of(text: str) -> str:
        out, rest = [], text
        names = {"id": "order_id", "tracking": "tracking_number", "reason": "cancellation_reason",
                 "type": "event_type"}
        while "{" in rest:
            pre, _, tail = rest.partition("{")
            name, _, rest = tail.partition("}")
            out += [f"'{pre}'", f"COALESCE({names[name]}, '')"]
        out.append(f"'{rest}'")
        return " || ".join(out)
    body = " ".join(f"WHEN '{k}' THEN {body_of(v[1])}" for k, v in config.NOTIFY_TEMPLATES.items())
    dsubj, dbody = config.NOTIFY_DEFAULT_TEMPLATE
    where = "TRUE" if default else "event_type IN (" + ", ".join(f"'{t}'" for t in config.NOTIFY_ORDER_TYPES) + ")"
    return f"""SELECT event_type, order_id, customer_email AS "to",
       CASE event_type {subj} ELSE '{dsubj}' END AS subject,
       CASE event_type {body} ELSE {body_of(dbody)} END AS body
FROM nevents WHERE {where}"""


CTE_LOW = f"""low AS (
  SELECT v.product_id, s.product_name, CAST(v.available AS INTEGER) AS remaining_stock,
         'warehouse@example.com' AS warehouse_manager_email
  FROM levels v LEFT JOIN stock_initial s ON s.product_id = v.product_id
  WHERE v.available < {config.LOW_STOCK_THRESHOLD})"""
ORDER_TYPES_SQL = "(" + ", ".join(f"'{t}'" for t in config.NOTIFY_ORDER_TYPES) + ")"

SQL.update({
    "n1_order_notifications": with_ctes(*ORDER_CTES, CTE_NOTIFY) + _n1(False),
    "n1_order_notifications_default": with_ctes(*ORDER_CTES, CTE_NOTIFY) + _n1(True),
    "n2_webhook_payloads": with_ctes(*ORDER_CTES, CTE_NOTIFY) + f"""SELECT event_type, order_id, webhook_url AS url,
       '{{"eventType":' || {_jstr('event_type')} || ',"OrderId":' || {_jstr('order_id')} || ',"Status":'
       || {_jstr('status')} || '}}' AS payload
FROM nevents WHERE event_type IN {ORDER_TYPES_SQL} AND webhook_url IS NOT NULL AND webhook_url <> ''""",
    "n4_low_stock_events": with_ctes(*INV_CTES, CTE_STOCK_LEDGER, CTE_LOW) + "SELECT * FROM low",
    "n3_low_stock_notifications": with_ctes(*INV_CTES, CTE_STOCK_LEDGER, CTE_LOW) + """SELECT product_id,
       warehouse_manager_email AS "to", 'Low stock alert: ' || COALESCE(product_name, '') AS subject,
       'Product ''' || COALESCE(product_name, '') || ''' (ID: ' || product_id || ') has only '
       || CAST(remaining_stock AS VARCHAR) || ' units remaining. Please restock.' AS body FROM low""",
    "n5_route_notifications": with_ctes(*ORDER_CTES, CTE_NOTIFY, CTE_CREATED_LINES, CTE_STOCK_LEDGER, CTE_LOW)
    + f"""SELECT event_type, entity_id,
       CASE WHEN event_type IN {ORDER_TYPES_SQL} THEN 'order'
            WHEN event_type = '{config.NOTIFY_INVENTORY_TYPE}' THEN 'inventory' ELSE 'unknown' END AS route
FROM (SELECT event_type, order_id AS entity_id FROM nevents
      UNION ALL SELECT '{config.NOTIFY_INVENTORY_TYPE}', product_id FROM low) x""",
})


# --------------------------------------------------------------------------- rate audits
def _fixed_sql(limit: int, seconds: int, key: str | None) -> str:
    us = seconds * 1_000_000
    k = f", {key}" if key else ""
    return f"""SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {us}) AS window_end{k},
       COUNT(*) AS request_count, COUNT(*) - {limit} AS excess
FROM (SELECT (epoch_us(ts) // {us}) * {us} AS ws{k} FROM events) x
GROUP BY ws{k} HAVING COUNT(*) > {limit}"""


def _sliding_sql(limit: int, seconds: int, segments: int) -> str:
    us, slide = seconds * 1_000_000, seconds * 1_000_000 // segments
    return f"""SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {us}) AS window_end,
       COUNT(*) AS request_count, COUNT(*) - {limit} AS excess
FROM (SELECT (epoch_us(ts) // {slide}) * {slide} - r.k * {slide} AS ws FROM events, range(0, {segments}) r(k)) x
GROUP BY ws HAVING COUNT(*) > {limit}"""


SQL.update({
    "k15_fixed_window_breaches_user": _fixed_sql(C.USER_LIMIT, C.USER_SECONDS, "user_id"),
    "k15_fixed_window_breaches_global": _fixed_sql(C.GLOBAL_LIMIT, C.GLOBAL_SECONDS, None),
    "k16_sliding_window_breaches": _sliding_sql(C.SLIDING_LIMIT, C.SLIDING_SECONDS, C.SLIDING_SEGMENTS),
})


# --------------------------------------------------------------------------- topic records / parsing
CTE_TOPIC = f"""recs AS (
  SELECT topic, CAST(event_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS order_id,
         CAST(user_id AS VARCHAR) AS customer_id, total_amount, status, event_time, event_type, value
  FROM (SELECT *, CAST(value AS {MONEY}) AS total_amount, {STATUS} AS status, {TOPIC} AS topic,
               ts AS event_time FROM events) e)"""
ERR = "CASE WHEN value < 100 THEN 'malformed_json' ELSE 'missing_field:orderId' END"
ENV_TYPE = ("CASE event_type WHEN 'OrderCreated' THEN 'ORDER_CREATED' WHEN 'OrderConfirmed' THEN 'ORDER_CONFIRMED' "
            "WHEN 'OrderShipped' THEN 'ORDER_SHIPPED' WHEN 'OrderDelivered' THEN 'ORDER_DELIVERED' "
            "WHEN 'OrderCancelled' THEN 'ORDER_CANCELLED' END")
CTE_ITEM_POS = """item_pos AS (
  SELECT order_id, product_id, quantity,
         CAST(row_number() OVER (PARTITION BY order_id ORDER BY line_no, product_id, product_name, quantity,
                                 unit_price) - 1 AS INTEGER) AS item_pos
  FROM order_lines)"""

SQL.update({
    "p1_parse_order_events": with_ctes(CTE_TOPIC) + f"""SELECT topic, key, order_id, customer_id,
       {r4('total_amount')} AS total_amount, status, event_time,
       CASE WHEN topic = 'order.created' THEN 1 ELSE 0 END AS n_items,
       CASE WHEN topic = 'order.created' THEN {r4('total_amount')} ELSE 0.0 END AS items_total
FROM recs WHERE event_type <> 'error'""",
    "p3_quarantine": with_ctes(CTE_TOPIC) + f"SELECT topic, key, {ERR} AS error FROM recs WHERE event_type = 'error'",
    "p3_error_counts": with_ctes(CTE_TOPIC) + f"""SELECT CASE WHEN event_type = 'error' THEN {ERR} END AS error,
       COUNT(*) AS records FROM recs GROUP BY 1""",
    "s9_dead_letter": with_ctes(CTE_TOPIC) + f"""SELECT '{config.DEAD_LETTER_TOPIC}' AS topic, key, {ERR} AS reason
FROM recs WHERE event_type = 'error'""",
    "p1_hourly_metrics_from_topics": with_ctes(CTE_TOPIC) + hourly_metrics_sql("recs", "event_type <> 'error'"),
    "u1_union_topics": with_ctes(CTE_TOPIC) + """SELECT topic, key, CAST(key AS BIGINT) AS "offset" FROM recs
WHERE topic IN ('order.created', 'order.confirmed', 'order.shipped', 'order.cancelled')""",
    "s1_read_order_topics": with_ctes(CTE_TOPIC) + """SELECT topic, key, CAST(key AS BIGINT) AS "offset" FROM recs
WHERE topic IN ('order.created', 'order.confirmed', 'order.shipped', 'order.cancelled')""",
    "p4_parse_envelopes": with_ctes(*ORDER_CTES) + f"""SELECT {ENV_TYPE} AS event_type, j.order_id,
       CAST(CASE WHEN j.event_type = 'OrderCreated' THEN j.n ELSE 0 END AS INTEGER) AS n_items,
       TRUE AS ok, NULL::VARCHAR AS error
FROM (SELECT j.*, (SELECT COUNT(*) FROM order_lines l WHERE l.order_id = j.order_id) AS n FROM journal j) j""",
    "p5_route_commands": with_ctes(*ORDER_CTES, CTE_ITEM_POS) + """SELECT p.product_id, 'reserve' AS kind,
       p.order_id, p.quantity, p.item_pos
FROM item_pos p JOIN journal j ON j.order_id = p.order_id AND j.event_type = 'OrderCreated'""",
    "p5_empty_item_events": with_ctes(*ORDER_CTES) + f"""SELECT {ENV_TYPE} AS event_type, order_id FROM journal
WHERE event_type IN ('OrderCancelled', 'OrderConfirmed')""",
    "k9_recovered_commands": with_ctes(*ORDER_CTES, CTE_ITEM_POS) + """SELECT p.product_id,
       CASE j.event_type WHEN 'OrderCancelled' THEN 'release' ELSE 'confirm' END AS kind,
       p.order_id, p.quantity, p.item_pos
FROM journal j JOIN item_pos p ON p.order_id = j.order_id
WHERE j.event_type IN ('OrderCancelled', 'OrderConfirmed')
  AND made""",
    "p11_validate_orders": with_ctes(CTE_ORDER_LINES) + f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       (l.n IS NOT NULL AND l.bad_q = 0 AND l.bad_p = 0) AS valid,
       concat_ws(',', CASE WHEN l.n IS NULL THEN 'items_empty' END,
                      CASE WHEN l.bad_q > 0 THEN 'quantity_below_1' END,
                      CASE WHEN l.bad_p > 0 THEN 'unit_price_not_positive' END) AS reasons,
       {r4('COALESCE(l.total, 0)')} AS total_amount
FROM orders LEFT JOIN (SELECT order_key, COUNT(*) AS n, SUM(line_total) AS total,
                              SUM(CASE WHEN quantity < 1 THEN 1 ELSE 0 END) AS bad_q,
                              SUM(CASE WHEN unit_price <= 0 THEN 1 ELSE 0 END) AS bad_p
                       FROM order_lines GROUP BY order_key) l ON l.order_key = o_orderkey""",
    "p12_items_json": with_ctes(*ORDER_CTES, CTE_CREATED_DOC) + "SELECT order_id, items_json FROM created_doc",
})


# --------------------------------------------------------------------------- streaming (availableNow)
SQL.update({
    "k14_hourly_metrics_stream": SQL["a1_hourly_metrics"],
    "k14_top_products_stream": SQL["a4_top_product_rows"],
})


# --------------------------------------------------------------------------- more source / sink / aggregate forms
SQL.update({
    "a10_batch_partial_metrics": with_ctes(CTE_METRIC_EVENTS) + f"""SELECT chunk, window_start, window_end,
       COUNT(*) AS order_count, {r4('SUM(total_amount)')} AS total_revenue
FROM (SELECT CAST(floor(CAST(order_id AS BIGINT) / {C.CHUNK_EVENTS}) AS BIGINT) AS chunk,
             date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL {config.WINDOW_SECONDS} SECOND AS window_end,
             total_amount FROM metric_events) x
GROUP BY chunk, window_start, window_end""",
    "a10_flush_partial_metrics": with_ctes(CTE_METRIC_EVENTS, f"""placed AS (
  SELECT row_number() OVER (ORDER BY event_time, CAST(order_id AS BIGINT)) AS i, * FROM metric_events)""", f"""steps AS (
  SELECT i, event_time, total_amount, CAST(order_id AS BIGINT) AS event_id,
         least(i + {config.BATCH_EVENTS}, 1 + max(i) OVER (ORDER BY event_time RANGE BETWEEN CURRENT ROW
               AND INTERVAL {C.FLUSH_SECONDS * 1_000_000 - 1} MICROSECOND FOLLOWING)) AS follow FROM placed)""", """starts AS (
  SELECT CAST(1 AS BIGINT) AS i UNION ALL SELECT s.follow FROM starts w JOIN steps s ON s.i = w.i)""").replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT x.event_id AS chunk_start, date_trunc('hour', e.event_time) AS window_start,
       date_trunc('hour', e.event_time) + INTERVAL {config.WINDOW_SECONDS} SECOND AS window_end,
       COUNT(*) AS order_count, {r4('SUM(e.total_amount)')} AS total_revenue
FROM starts w JOIN steps x ON x.i = w.i JOIN steps e ON e.i >= x.i AND e.i < x.follow
GROUP BY x.event_id, window_start, window_end""",
    "k6_inventory_reservation_map": with_ctes(*INV_CTES, CTE_STOCK_LEDGER) + """SELECT o.product_id, o.order_id,
       o.quantity, v.available, v.reserved, v.total
FROM open_res o JOIN levels v ON v.product_id = o.product_id""",
    "s2_read_order_envelopes": with_ctes(*ORDER_CTES) + f"""SELECT '{config.ORDER_EVENTS_TOPIC}' AS topic,
       order_id AS key, {ENV_TYPE} AS event_type, TRUE AS ok FROM journal""",
    "s3_read_notification_events": SQL["n1_order_notifications"],
})

SQL["k11_order_summary_stream"] = SQL["w1_replay_order_state"]
SQL["k12_saga_status_stream"] = SQL["k12_saga_status"]
SQL["s9_dead_letter_stream"] = SQL["s9_dead_letter"]
SQL["n1_order_notifications_stream"] = SQL["n1_order_notifications"]
SQL["s9_notification_sinks_stream"] = with_ctes(*ORDER_CTES, CTE_NOTIFY, CTE_CREATED_LINES, CTE_STOCK_LEDGER, CTE_LOW) + f"""
SELECT sink, event_type, reason, COUNT(*) AS records FROM (
  SELECT CASE WHEN event_type NOT IN {ORDER_TYPES_SQL} THEN 'others'
              WHEN damaged AND event_type IN ('OrderConfirmed', 'OrderShipped') THEN 'dead_letters' ELSE 'notifications' END AS sink, event_type,
         CASE WHEN damaged AND event_type = 'OrderConfirmed' THEN 'malformed_json'
              WHEN damaged AND event_type = 'OrderShipped' THEN 'missing_field:OrderId' WHEN event_type NOT IN {ORDER_TYPES_SQL} THEN 'unknown' END AS reason
  FROM (SELECT n.event_type, o.o_orderpriority = '{C.DAMAGED_PRIORITY}' AS damaged FROM nevents n JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = n.order_id) d
  UNION ALL SELECT 'others', '{config.NOTIFY_INVENTORY_TYPE}', 'inventory' FROM low) x
GROUP BY sink, event_type, reason"""
SQL["k15_fixed_window_breaches_stream"] = SQL["k15_fixed_window_breaches_user"]


# --------------------------------------------------------------------------- sequential folds
# A fold is a recursive CTE over the row number within its key: one step a command.
CTE_STOCK_COMMANDS = f"""commands AS (
  SELECT product_id, 'replenish' AS kind, NULL::VARCHAR AS order_id, available AS quantity,
         TIMESTAMP '{D.EPOCH}' AS ts, CAST(-1 AS BIGINT) AS seq, NULL::INTEGER AS line_no FROM stock_initial
  UNION ALL SELECT product_id, 'reserve', order_id, quantity, created_at, seq, line_no FROM created_lines
  UNION ALL SELECT product_id, 'confirm', order_id, quantity, created_at + INTERVAL 1 DAY, seq, line_no
  FROM created_lines WHERE o_orderstatus IN ('P', 'F')
  UNION ALL SELECT product_id, 'release', order_id, quantity, created_at + INTERVAL 1 DAY, seq, line_no
  FROM created_lines WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
  UNION ALL SELECT product_id, 'release', order_id, quantity, created_at + INTERVAL 3 DAY, seq, line_no
  FROM created_lines WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""

CTE_RESERVE_COMMANDS = CTE_STOCK_COMMANDS.split("  UNION ALL SELECT product_id, 'confirm'")[0].rstrip() + ")"


def _message(template: str, **values: str) -> str:
    """SQL text of a message template: its placeholders become columns."""
    sql = "'" + template.replace("'", "''") + "'"
    for name, column in values.items():
        sql = sql.replace("{" + name + "}", f"' || CAST({column} AS VARCHAR) || '")
    return sql


# open reservations travel as two lists (orders, quantities); ``pos`` is the command's place in them
CTE_STOCK_FOLD = f"""numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ts, seq, line_no NULLS FIRST, quantity) AS rn FROM commands),
fold AS (
  SELECT product_id, CAST(0 AS BIGINT) AS rn, 0 AS available, 0 AS reserved, CAST([] AS VARCHAR[]) AS orders, CAST([] AS INTEGER[]) AS held,
         NULL::VARCHAR AS kind, NULL::VARCHAR AS order_id, NULL::INTEGER AS quantity, NULL::TIMESTAMP AS ts, NULL::BIGINT AS seq,
         NULL::INTEGER AS line_no, NULL::BOOLEAN AS ok, NULL::BOOLEAN AS applied, 0 AS eff, NULL::VARCHAR AS message
  FROM (SELECT DISTINCT product_id FROM numbered) p
  UNION ALL
  SELECT product_id, rn,
         CAST(available + CASE WHEN NOT applied THEN 0 WHEN kind = 'reserve' THEN -eff WHEN kind IN ('release', 'replenish') THEN eff ELSE 0 END AS INTEGER),
         CAST(reserved + CASE WHEN NOT applied THEN 0 WHEN kind = 'reserve' THEN eff WHEN kind IN ('release', 'confirm') THEN -eff ELSE 0 END AS INTEGER),
         CASE WHEN applied AND kind = 'reserve' THEN list_append(orders, order_id)
              WHEN applied AND kind IN ('release', 'confirm') THEN list_concat(orders[1:pos - 1], orders[pos + 1:]) ELSE orders END,
         CASE WHEN applied AND kind = 'reserve' THEN list_append(held, eff)
              WHEN applied AND kind IN ('release', 'confirm') THEN list_concat(held[1:pos - 1], held[pos + 1:]) ELSE held END,
         kind, order_id, quantity, ts, seq, line_no, ok, applied, eff, message
  FROM (
    SELECT *,
           CASE kind WHEN 'reserve' THEN pos > 0 OR (quantity > 0 AND available >= quantity) WHEN 'confirm' THEN pos > 0
                     WHEN 'replenish' THEN quantity > 0 ELSE true END AS ok,
           CASE kind WHEN 'reserve' THEN pos = 0 AND quantity > 0 AND available >= quantity WHEN 'replenish' THEN quantity > 0 ELSE pos > 0 END AS applied,
           CASE WHEN kind IN ('reserve', 'release', 'confirm') AND pos > 0 THEN held[pos]
                WHEN kind = 'reserve' AND quantity > 0 AND available >= quantity THEN quantity
                WHEN kind = 'replenish' AND quantity > 0 THEN quantity ELSE 0 END AS eff,
           CASE WHEN kind = 'reserve' AND pos = 0 AND quantity <= 0 THEN {_message(config.MSG_QTY_NOT_POSITIVE, q="quantity")}
                WHEN kind = 'reserve' AND pos = 0 AND available < quantity THEN {_message(config.MSG_INSUFFICIENT, pid="product_id", avail="available", q="quantity")}
                WHEN kind = 'confirm' AND pos = 0 THEN {_message(config.MSG_NO_RESERVATION, oid="order_id", pid="product_id")}
                WHEN kind = 'replenish' AND quantity <= 0 THEN {_message(config.MSG_REPLENISH_NOT_POSITIVE, q="quantity")} END AS message
    FROM (SELECT n.product_id, n.rn, n.kind, n.order_id, n.quantity, n.ts, n.seq, n.line_no, f.available, f.reserved, f.orders, f.held,
                 COALESCE(list_position(f.orders, n.order_id), 0) AS pos
          FROM fold f JOIN numbered n ON n.product_id = f.product_id AND n.rn = f.rn + 1) c) d),
results AS (SELECT product_id, kind, order_id, quantity, ts, seq, line_no, ok, applied, CAST(eff AS INTEGER) AS effective_quantity, message,
                   available AS available_after, reserved AS reserved_after, rn FROM fold WHERE rn > 0)"""

CTE_FOLD_OUTCOME = f"""fold_outcome AS (
  SELECT order_id, bool_and(ok) AS reserved, COUNT(*) AS n_items, CAST(SUM(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS n_failed,
         string_agg(CASE WHEN NOT ok THEN product_id || ': ' || message END, '@@' ORDER BY line_no, product_id, message) AS failures
  FROM results WHERE kind = 'reserve' GROUP BY order_id)"""


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


FOLD = [*INV_CTES, CTE_STOCK_COMMANDS, CTE_STOCK_FOLD]
RESERVE_FOLD = [*INV_CTES, CTE_RESERVE_COMMANDS, CTE_STOCK_FOLD, CTE_FOLD_OUTCOME]
RESULT_COLS = ", ".join(c.strip().split(" ")[0] for c in STOCK_RESULT_DDL.split(","))


def _reason(prefix: str, sep: str) -> str:
    return f"'{prefix}' || replace(failures, '@@', '{sep}')"


K2_SQL = with_recursive(*FOLD) + f"SELECT {RESULT_COLS} FROM results"
K7_SQL = with_recursive(*RESERVE_FOLD) + f"""SELECT order_id, reserved, n_items, n_failed,
       {_reason(config.INSUFFICIENT_STOCK_PREFIX, ', ')} AS reason FROM fold_outcome"""
SQL.update({
    "k2_reserve_stock": K2_SQL,
    "k2_reserve_stock_split": K2_SQL,
    "k2_reserve_stock_stream": K2_SQL,
    "k9_release_confirm_orders": with_recursive(*FOLD) + f"SELECT {RESULT_COLS} FROM results WHERE kind IN ('release', 'confirm')",
    "k2_stock_after_fold": with_recursive(*FOLD) + """SELECT product_id, CAST(available AS BIGINT) AS available, CAST(reserved AS BIGINT) AS reserved,
       CAST(available + reserved AS BIGINT) AS total, len(orders) AS open_reservations
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY rn DESC) AS last FROM fold) f
WHERE last = 1 AND product_id IN (SELECT product_id FROM results WHERE applied)""",
    "k7_reserve_orders": K7_SQL,
    "k7_reserve_orders_stream": K7_SQL,
    "k7_stock_after_compensation": with_recursive(*RESERVE_FOLD) + """SELECT product_id, CAST(a.available AS BIGINT) AS available,
       CAST(a.reserved AS BIGINT) AS reserved, CAST(a.available + a.reserved AS BIGINT) AS total, a.open_reservations
FROM (SELECT r.product_id, SUM(CASE WHEN r.kind = 'replenish' THEN r.effective_quantity WHEN o.reserved THEN -r.effective_quantity ELSE 0 END) AS available,
             SUM(CASE WHEN o.reserved THEN r.effective_quantity ELSE 0 END) AS reserved, COUNT(CASE WHEN o.reserved THEN 1 END) AS open_reservations
      FROM results r LEFT JOIN fold_outcome o ON o.order_id = r.order_id WHERE r.applied GROUP BY r.product_id) a""",
    "k8_batch_reserve": with_recursive(*RESERVE_FOLD) + f"""SELECT order_id, reserved AS success,
       CASE WHEN reserved THEN {_message(config.MSG_ALL_RESERVED, n="n_items", oid="order_id")} ELSE {_reason(config.BATCH_FAILED_PREFIX, '; ')} END AS message
FROM fold_outcome""",
    "k9_stock_commands_stream": with_recursive(*FOLD, CTE_FOLD_OUTCOME) + """SELECT f.product_id, CAST(f.available + COALESCE(b.back, 0) AS BIGINT) AS available,
       CAST(f.reserved - COALESCE(b.back, 0) AS BIGINT) AS reserved
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY rn DESC) AS last FROM fold) f
LEFT JOIN (SELECT product_id, SUM(qty) AS back FROM (
             SELECT product_id, unnest(orders) AS order_id, unnest(held) AS qty
             FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY rn DESC) AS last FROM fold) e WHERE last = 1) h
           WHERE order_id IN (SELECT order_id FROM fold_outcome WHERE NOT reserved) GROUP BY product_id) b ON b.product_id = f.product_id
WHERE last = 1 AND f.product_id IN (SELECT product_id FROM created_lines)""",
    "s8_inventory_event_records": with_recursive(*RESERVE_FOLD) + f"""SELECT '{config.INVENTORY_EVENTS_TOPIC}' AS topic, f.order_id AS key,
       '{{"eventType":"' || event_type || '","inventoryId":"inv-' || f.order_id || '","orderId":"' || f.order_id || '"'
       || COALESCE(',"reason":"' || {_reason(config.INSUFFICIENT_STOCK_PREFIX, ', ')} || '"', '')
       || ',"timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"}}' AS value, event_type
FROM (SELECT *, CASE WHEN reserved THEN '{config.INVENTORY_RESERVED}' ELSE '{config.INVENTORY_RESERVATION_FAILED}' END AS event_type FROM fold_outcome) f
JOIN orders ON CAST(o_orderkey AS VARCHAR) = f.order_id""",
})

COMMAND = _case("event_type", COMMAND_OF_EVENT, "NULL")
_NEEDS = _case("c.command", {c: need for c, (need, _, _) in config.COMMAND_TRANSITIONS.items()}, "NULL")
_EMITS = _case("c.command", {c: event for c, (_, event, _) in config.COMMAND_TRANSITIONS.items()}, "NULL")
_MAKES = _case("c.command", {c: new for c, (_, _, new) in config.COMMAND_TRANSITIONS.items()}, "NULL")
K10_SQL = with_recursive(*ORDER_CTES, f"""ncmd AS MATERIALIZED (
  SELECT order_id, seq, {COMMAND} AS command, ts, row_number() OVER (PARTITION BY order_id ORDER BY seq, ts) AS rn FROM journal),
fold AS (
  SELECT DISTINCT order_id, CAST(0 AS BIGINT) AS rn, NULL::BIGINT AS seq, NULL::VARCHAR AS command, NULL::TIMESTAMP AS ts, NULL::BOOLEAN AS accepted,
         NULL::VARCHAR AS emitted_event, NULL::VARCHAR AS status_before, NULL::VARCHAR AS status_after, NULL::VARCHAR AS message FROM ncmd
  UNION ALL
  SELECT order_id, rn, seq, command, ts, accepted, CASE WHEN accepted AND NOT silent THEN event END,
         status, CASE WHEN accepted AND NOT silent THEN new_status ELSE status END,
         CASE WHEN accepted AND NOT silent THEN NULL
              WHEN command = 'create' THEN {_message(config.MSG_ALREADY_EXISTS, oid="order_id")}
              WHEN status IS NULL THEN {_message(config.MSG_NOT_FOUND, oid="order_id")}
              WHEN silent THEN {_message(config.MSG_ALREADY_CANCELLED, oid="order_id")}
              WHEN command = 'cancel' THEN {_message(config.MSG_CANNOT_CANCEL, oid="order_id", status="status")}
              ELSE {_message(config.MSG_WRONG_STATUS, op="command", oid="order_id", status="status", expected="needs")} END
  FROM (SELECT c.*, f.status_after AS status, {_NEEDS} AS needs,
               CASE c.command WHEN 'create' THEN 'OrderCreated' WHEN 'cancel' THEN 'OrderCancelled' ELSE {_EMITS} END AS event,
               CASE c.command WHEN 'create' THEN 'PENDING' WHEN 'cancel' THEN 'CANCELLED' ELSE {_MAKES} END AS new_status,
               c.command = 'cancel' AND COALESCE(f.status_after, '') = 'CANCELLED' AS silent,
               CASE c.command WHEN 'create' THEN f.status_after IS NULL
                    WHEN 'cancel' THEN COALESCE(f.status_after, 'SHIPPED') NOT IN ('SHIPPED', 'DELIVERED')
                    ELSE COALESCE(f.status_after = {_NEEDS}, false) END AS accepted
        FROM fold f JOIN ncmd c ON c.order_id = f.order_id AND c.rn = f.rn + 1) x)""") + f"""
SELECT {", ".join(c.strip().split(" ")[0] for c in ORDER_COMMAND_RESULT_DDL.split(","))} FROM fold WHERE rn > 0"""
_ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
SQL.update({
    "k10_order_commands": K10_SQL,
    "k10_order_commands_stream": K10_SQL,
    "s10_publish_order_events": with_ctes(*ORDER_CTES, CTE_CREATED_DOC, """kitems AS (
  SELECT order_id, '[' || string_agg('{"productId":"' || product_id || '","quantity":' || CAST(quantity AS VARCHAR) || '}', ','
         ORDER BY line_no, product_id, product_name, quantity, unit_price) || ']' AS items FROM order_lines GROUP BY order_id)""") + f"""
SELECT '{config.ORDER_EVENTS_TOPIC}' AS topic, order_id AS key,
       '{{"eventType":"' || etype || '","payload":"' || replace(replace(payload, '\\', '\\\\'), '"', '\\"') || '"}}' AS value,
       0 AS partition, CAST(order_key * 8 + seq AS BIGINT) AS offset, ts AS timestamp
FROM (SELECT j.*, {_case("j.event_type", TP.ENVELOPE_TYPE_OF_EVENT, "NULL")} AS etype,
        CASE j.event_type WHEN 'OrderCreated' THEN '{{"orderId":"' || j.order_id || '"' || COALESCE(',"customerId":"' || j.customer_id || '"', '')
               || ',"items":' || COALESCE(k.items, '[]') || COALESCE(',"totalAmount":' || CAST(j.total_amount AS VARCHAR), '')
               || COALESCE(',"shippingAddress":"' || d.shipping_address || '"', '') || ',"createdAt":"' || strftime(j.ts, {_ISO}) || '"}}'
             WHEN 'OrderCancelled' THEN '{{"orderId":"' || j.order_id || '"' || COALESCE(',"reason":"' || j.reason || '"', '') || ',"items":[]}}'
             ELSE '{{"orderId":"' || j.order_id || '","items":[]}}' END AS payload
      FROM journal j LEFT JOIN kitems k ON k.order_id = j.order_id LEFT JOIN created_doc d ON d.order_id = j.order_id) x""",
})
