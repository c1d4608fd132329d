"""Domain frames derived from the driver's tables.

Every frame here is a narrow projection/join of the parquet tables, so the
work grows with the data. The derivation rules are deterministic and use only
columns of the tables (no hashing, sampling or row caps):

* order line    = lineitem ⋈ part: product = l_partkey, quantity = l_quantity,
                  unit price = p_retailprice (so line totals are exact decimals)
* order journal = per order, in sequence:
    0 OrderCreated    at o_orderdate         — only orders with ≥ 1 line (P11)
    1 OrderConfirmed  at +1 day              — status P or F
    1 OrderCancelled  at +1 day              — status O and priority 5-LOW
    2 OrderShipped    at +2 days             — status F (tracking PKG-<key>)
    3 OrderDelivered  at +5 days             — status F, priority 1-URGENT/2-HIGH
    3 OrderCancelled  at +3 days (recalled) — status F and priority 5-LOW
                                               (an illegal transition on purpose)
  Orders without lines still get their status events: orphans (J5, q8).
* customer      = email from c_name, webhook for segment BUILDING
* stock         = initial available p_size × STOCK_PER_SIZE_UNIT per part
* metric events = ``events``: event_type → topic → status, value → amount,
                  purchase events carry one item (product $.k, quantity 1)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.functions.columns import line_total, money, topic_to_status
from ledgerline.schemas import MONEY, ORDER_ITEM
from ledgerline.sources.tables import Tables

EPOCH = "1990-01-01 00:00:00"
# our own sample values
CARRIER_BY_PRIORITY = {"1-URGENT": "Northway Express", "2-HIGH": "Bluefreight"}
DEFAULT_CARRIER = "Parcelline"
TRACKING_PREFIX = "PKG-"
CANCEL_REASON_EARLY = "changed my mind"
CANCEL_REASON_LATE = "recalled after dispatch"


def _days(c: Column, n: int) -> Column:
    return c + F.make_interval(days=F.lit(n))


def _lines_of_parts(t: Tables) -> DataFrame:
    """Lines with their part, as the tables hold them: nothing is widened before the joins that follow."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    return (li.join(p, li.l_partkey == p.p_partkey, "inner")
            .select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey", "l_quantity", "p_name", "p_retailprice"))


def _line_columns() -> list[Column]:
    return [F.col("order_key"), F.col("order_key").cast("string").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("l_quantity").cast("int").alias("quantity"), money("p_retailprice").alias("unit_price")]


def order_lines(t: Tables) -> DataFrame:
    """One row per order line with exact money columns."""
    return _lines_of_parts(t).select(*_line_columns()).withColumn("line_total", line_total("unit_price", "quantity"))


def order_headers(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"))


def order_line_totals(t: Tables) -> DataFrame:
    """P7 on the line table: Σ line totals and line count per order (partial agg)."""
    return (order_lines(t).groupBy("order_key")
            .agg(F.sum("line_total").cast(MONEY).alias("total_amount"),
                 F.count(F.lit(1)).alias("n_lines")))


def customers(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_mktsegment") == "BUILDING",
               F.concat(F.lit("https://hooks.example.com/customers/"), F.col("c_custkey").cast("string")))
         .alias("webhook_url"),
        F.concat(F.lit("Street "), F.col("c_custkey").cast("string"), F.lit(", nation "),
                 F.col("c_nationkey").cast("string")).alias("shipping_address"),
        F.col("c_acctbal").alias("acctbal"))


def order_line_counts(t: Tables) -> DataFrame:
    """Line count per order alone: which orders were created, without reading amounts."""
    return order_lines(t).groupBy("order_key").agg(F.count(F.lit(1)).alias("n_lines"))


def order_journal(t: Tables, header: tuple[str, ...] = (), totals: bool = True, contents: bool = False) -> DataFrame:
    """Ordered event log per order (S4 shape), one scan of orders, no union.

    ``header`` columns of the order (``created_by``: the customer of its Created event, null without one;
    or any of ``order_headers``) are put on each of its events, so no event has to look for its Created.
    Without ``totals`` the Created events carry no amount, and of the lines only the keys are read.
    With ``contents`` each event carries its order's ``items`` (product_id, quantity) and ``shipping_address``, made
    in the aggregate that makes the totals; as by a join with ``order_created``, once for each of its rows of the order.
    """
    h = order_headers(t)
    if contents:
        header = (*header, "items", "shipping_address")
        item = F.struct("line_no", "product_id", "quantity")
        tot = order_lines(t).groupBy("order_key").agg(
            F.sum("line_total").cast(MONEY).alias("total_amount"), F.count(F.lit(1)).alias("n_lines"),
            F.transform(F.sort_array(F.collect_list(item)), lambda i: F.struct(i["product_id"], i["quantity"])).alias("items"))
        c = customers(t).select("customer_id", "shipping_address")
        h = h.join(h.select("order_key", "customer_id").join(c, "customer_id", "left").select("order_key", "shipping_address"), "order_key", "left")
    else:
        tot = order_line_totals(t) if totals else order_line_counts(t)
    base = h.join(tot, "order_key", "left").withColumn("created_by", F.when(F.col("n_lines").isNotNull(), F.col("customer_id")))
    st, pr, at = F.col("order_status"), F.col("priority"), F.col("created_at")

    def ev(cond, seq, etype, ts, customer=None, total=None, tracking=None, carrier=None, reason=None):
        return F.when(cond, F.struct(
            F.lit(seq).cast("long").alias("seq"),
            F.lit(etype).alias("event_type"),
            ts.alias("ts"),
            (customer if customer is not None else F.lit(None).cast("string")).alias("customer_id"),
            (total if total is not None else F.lit(None).cast(MONEY)).alias("total_amount"),
            (tracking if tracking is not None else F.lit(None).cast("string")).alias("tracking_number"),
            (carrier if carrier is not None else F.lit(None).cast("string")).alias("carrier"),
            (reason if reason is not None else F.lit(None).cast("string")).alias("reason")))

    carrier = F.lit(DEFAULT_CARRIER)
    for prio, name in reversed(list(CARRIER_BY_PRIORITY.items())):
        carrier = F.when(pr == prio, F.lit(name)).otherwise(carrier)
    events = F.array_compact(F.array(
        ev(F.col("n_lines").isNotNull(), 0, "OrderCreated", at, F.col("customer_id"), F.col("total_amount") if totals else None),
        ev(st.isin("P", "F"), 1, "OrderConfirmed", _days(at, 1)),
        ev((st == "O") & (pr == "5-LOW"), 1, "OrderCancelled", _days(at, 1), reason=F.lit(CANCEL_REASON_EARLY)),
        ev(st == "F", 2, "OrderShipped", _days(at, 2),
           tracking=F.concat(F.lit(TRACKING_PREFIX), F.col("order_id")), carrier=carrier),
        ev((st == "F") & pr.isin("1-URGENT", "2-HIGH"), 3, "OrderDelivered", _days(at, 5)),
        ev((st == "F") & (pr == "5-LOW"), 3, "OrderCancelled", _days(at, 3), reason=F.lit(CANCEL_REASON_LATE)),
    ))
    return (base.select("order_id", "order_key", *header, F.explode(events).alias("e"))
            .select("order_id", "order_key", *header, "e.*"))


def order_created(t: Tables) -> DataFrame:
    """OrderCreated events in the domain shape, items as an array of structs.

    Only for consumers that need the array (validation, JSON, read model);
    aggregates read ``order_lines`` directly instead of exploding this.
    """
    items = (order_lines(t).groupBy("order_key")
             .agg(F.sort_array(F.collect_list(F.struct(
                 "line_no", F.struct(*[F.col(f.name) for f in ORDER_ITEM.fields]).alias("item"))))
                  .alias("lines")))
    h = order_headers(t)
    c = customers(t).select("customer_id", "shipping_address")
    return (h.join(items, "order_key", "left")
            .join(c, "customer_id", "left")
            .select("order_id", "order_key", "customer_id",
                    F.coalesce(F.transform("lines", lambda x: x["item"]),
                               F.array().cast(f"array<{ORDER_ITEM.simpleString()}>")).alias("items"),
                    "shipping_address", "created_at", "order_status", "priority"))


def stock_initial(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        (F.col("p_size") * F.lit(config.STOCK_PER_SIZE_UNIT)).cast("int").alias("available"))


def event_topic(event_type) -> Column:
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for et, topic in config.EVENT_TYPE_TOPIC.items():
        expr = F.when(c == et, F.lit(topic)) if expr is None else expr.when(c == et, F.lit(topic))
    return expr.otherwise(c)


def metric_events(t: Tables, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalised order events from ``events`` (no JSON round trip); ``keep`` raw columns too."""
    return normalise_events(t.events, keep)


def normalise_events(e: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Batch or streaming ``events`` rows → normalised order events.

    Two projections: shared sub-expressions (topic, product key, amount) are
    computed once and referenced by name, so no JSON lookup is repeated.
    """
    base = e.select(event_topic("event_type").alias("topic"), F.get_json_object("props", "$.k").alias("_k"),
                    money("value").alias("_amount"), "event_id", "user_id", "ts",
                    *[c for c in keep if c not in ("event_id", "user_id", "ts")])
    k, amount = F.col("_k"), F.col("_amount")
    item = F.struct(k.alias("product_id"), F.concat(F.lit("product-"), k).alias("product_name"),
                    F.lit(1).alias("quantity"), amount.alias("unit_price"))
    empty = F.array().cast(f"array<{ORDER_ITEM.simpleString()}>")
    return base.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        amount.alias("total_amount"),
        F.when(F.col("topic") == "order.created", F.array(item)).otherwise(empty).alias("items"),
        topic_to_status(F.col("topic")).alias("status"),
        F.col("ts").cast("timestamp").alias("event_time"),
        "topic", *keep)


def metric_event_items(t: Tables) -> DataFrame:
    """Item rows of metric events without building arrays (for A2–A4)."""
    return event_items(t.events)


def event_items(e: DataFrame) -> DataFrame:
    """Batch or streaming ``events`` rows → item rows of created events."""
    topic = event_topic("event_type")
    return (e.where(topic == "order.created")
            .select(F.col("ts").cast("timestamp").alias("event_time"),
                    F.get_json_object("props", "$.k").alias("product_id"),
                    F.lit(1).alias("quantity"),
                    money("value").alias("unit_price")))


# --------------------------------------------------------------------------- stock
def arrival_seq(order_key: Column) -> Column:
    """Arrival sequence of an order's lines; the lines of one order follow by ``line_no``."""
    return order_key.cast("long")


def created_lines(t: Tables) -> DataFrame:
    """Lines of created orders with the order's arrival time and a sequence."""
    h = order_headers(t).select("order_key", "created_at", "order_status", "priority")
    return (_lines_of_parts(t).join(h, "order_key")
            .select(*_line_columns(), "created_at", "order_status", "priority")
            .withColumn("line_total", line_total("unit_price", "quantity"))
            .withColumn("ts", F.col("created_at"))
            .withColumn("seq", arrival_seq(F.col("order_key"))))


def stock_commands(t: Tables) -> DataFrame:
    """Stock command log: initial replenish, then per line reserve / confirm / release.

    Confirm for orders confirmed (+1 day), release for cancelled orders
    (+1 day early cancel; +3 days late cancel, which finds nothing to release).
    """
    lines = created_lines(t)
    st, pr, at = F.col("order_status"), F.col("priority"), F.col("created_at")

    def cmd(cond, kind, ts):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), ts.alias("ts")))

    cmds = F.array_compact(F.array(
        cmd(F.lit(True), "reserve", at),
        cmd(st.isin("P", "F"), "confirm", _days(at, 1)),
        cmd((st == "O") & (pr == "5-LOW"), "release", _days(at, 1)),
        cmd((st == "F") & (pr == "5-LOW"), "release", _days(at, 3)),
    ))
    per_line = (lines.select("product_id", "order_id", "quantity", "seq", "line_no", F.explode(cmds).alias("c"))
                .select("product_id", "c.kind", "order_id", "quantity", "c.ts", "seq", "line_no"))
    init = stock_initial(t).select(
        "product_id", F.lit("replenish").alias("kind"), F.lit(None).cast("string").alias("order_id"),
        F.col("available").alias("quantity"), F.lit(EPOCH).cast("timestamp").alias("ts"),
        F.lit(-1).cast("long").alias("seq"), F.lit(None).cast("int").alias("line_no"))
    return init.unionByName(per_line)


def stock_event_ledger(t: Tables) -> DataFrame:
    """A stock event log as written (no rejections): input of K1/K6 checks.

    Replenish per part; one reservation per (order, product) — the first
    line's quantity (q10) — confirmed for confirmed orders and released for
    early-cancelled ones.
    """
    # first line per (order, product) by (line_no, quantity), packed into one long so the
    # aggregate buffer is fixed-width (hash aggregate); only the keys as the tables hold them
    # are grouped, and the orders are joined to the groups
    code = (F.col("l_linenumber").cast("long") * F.lit(1 << 32)
            + (F.col("l_quantity").cast("int").cast("long") + F.lit(1 << 31)))
    li = t.lineitem.select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey", "l_quantity")
    p = t.part.select("p_partkey")
    head = order_headers(t).select("order_key", "created_at", "order_status", "priority").distinct()
    first = (li.join(p, li.l_partkey == p.p_partkey, "left_semi")
             .groupBy("order_key", "l_partkey")
             .agg(F.min(code).alias("_code"))
             .join(head, "order_key")
             .select("order_key", F.col("order_key").cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"),
                     F.struct((F.floor(F.col("_code") / F.lit(1 << 32))).cast("int").alias("line_no"),
                              (F.pmod(F.col("_code"), F.lit(1 << 32)) - F.lit(1 << 31)).cast("int").alias("quantity"),
                              "created_at", "order_status", "priority").alias("f")))
    st, pr, at = F.col("f.order_status"), F.col("f.priority"), F.col("f.created_at")

    def ev(cond, etype, ts):
        return F.when(cond, F.struct(F.lit(etype).alias("event_type"), ts.alias("ts")))

    evs = F.array_compact(F.array(
        ev(F.lit(True), "StockReserved", at),
        ev(st.isin("P", "F"), "ReservationConfirmed", _days(at, 1)),
        ev((st == "O") & (pr == "5-LOW"), "ReservationReleased", _days(at, 1)),
    ))
    per = (first.select("product_id", "order_id", F.col("f.quantity").alias("quantity"),
                        arrival_seq(F.col("order_key")).alias("seq"), F.explode(evs).alias("e"))
           .select("product_id", "e.event_type", "order_id", "quantity", "e.ts", "seq"))
    init = stock_initial(t).select(
        "product_id", F.lit("StockReplenished").alias("event_type"), F.lit(None).cast("string").alias("order_id"),
        F.col("available").alias("quantity"), F.lit(EPOCH).cast("timestamp").alias("ts"),
        F.lit(-1).cast("long").alias("seq"))
    return init.unionByName(per)


def item_results_initial(t: Tables) -> DataFrame:
    """Per item of every created order: can initial stock alone cover it?

    An order-independent reservation check (input for J3/J4/A9): ok iff
    0 < quantity ≤ initial available stock of the product.
    """
    s = stock_initial(t).select("product_id", "available")
    lines = created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    j = lines.join(s, "product_id", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    ok = (F.col("quantity") > 0) & (F.col("quantity") <= F.col("available"))
    msg = F.when(F.col("quantity") <= 0,
                 F.format_string(config.MSG_QTY_NOT_POSITIVE.replace("{q}", "%d"), F.col("quantity"))) \
           .when(~ok, F.format_string(config.MSG_INSUFFICIENT.replace("{pid}", "%s").replace("{avail}", "%d")
                                      .replace("{q}", "%d"), F.col("product_id"), F.col("available"),
                                      F.col("quantity")))
    return j.select("order_id", "line_no", "product_id", "quantity", "ts", "seq",
                    ok.alias("ok"), msg.alias("message"))


# --------------------------------------------------------------------------- notifications
def notification_events(t: Tables, header: tuple[str, ...] = ()) -> DataFrame:
    """Order events as the notification service receives them (key = event type).

    Status events take customer e-mail / webhook of their order's Created
    event (q8); orphans keep them null. ``header``: further columns of the order.
    """
    j = order_journal(t, ("created_by", *header))
    c = customers(t).select(F.col("customer_id").alias("created_by"), "email", "webhook_url")
    status = F.upper(F.regexp_replace("event_type", "^Order", ""))
    return (j.join(c, "created_by", "left")
            .select("event_type", "order_id", F.col("email").alias("customer_email"), status.alias("status"),
                    "tracking_number", F.col("reason").alias("cancellation_reason"), "webhook_url", "ts", *header))


# --------------------------------------------------------------------------- topic records
MALFORMED_BELOW = 100.0   # error events below this value are truncated JSON, others lack orderId


def order_topic_records(t: Tables) -> DataFrame:
    """Analytics topic records from ``events`` (JSON values, as on the wire).

    ``error`` events become bad records: truncated JSON when value < 100,
    otherwise a status JSON without ``orderId``.
    """
    from ledgerline.sources.topics import order_created_json, order_status_json
    e = metric_events(t, keep=("event_type", "value", "user_id", "event_id"))
    good = F.when(F.col("topic") == "order.created",
                  order_created_json(F.col("order_id"), F.col("customer_id"), F.col("items"),
                                     F.col("total_amount"), F.col("event_time"))) \
            .otherwise(order_status_json(F.col("order_id"), F.col("customer_id"), F.col("status"),
                                         F.col("total_amount"), F.col("event_time")))
    no_id = F.to_json(F.struct(F.col("customer_id").alias("customerId"), F.col("status").alias("status"),
                               F.col("total_amount").alias("totalAmount")))
    e = e.withColumn("_good", F.when(F.col("event_type") != "error", good)
                     .otherwise(F.when(F.col("value") < MALFORMED_BELOW, F.substring(good, 1, 20))))
    value = F.coalesce(F.col("_good"), no_id)
    return e.select("topic", F.col("order_id").alias("key"), value.alias("value"),
                    F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"), F.col("event_time").alias("timestamp"))
