"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each query reads the whole tables of ``sf_dir`` (or frames Spark derives from
them); limits appear only where they are the feature (top-k, one page).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import order_total
from ledgerline.functions.jsonfmt import extract_skus, items_to_json
from ledgerline.operators import batching as B
from ledgerline.operators import commands as K
from ledgerline.operators import inventory as I
from ledgerline.operators import metrics as M
from ledgerline.operators import notify as N
from ledgerline.operators import orders as O
from ledgerline.operators import parse as P
from ledgerline.operators import rates as R
from ledgerline.operators import saga as S
from ledgerline.operators import split_fold as SF
from ledgerline.operators import stock_view as V
from ledgerline.plans.present import present
from ledgerline.session import drop_folder, ensure_checkpoint_dir, free_shuffles, scratch_path
from ledgerline.sources import domain as D
from ledgerline.sources import journal as JN
from ledgerline.sources import topics as TP
from ledgerline.sources.sinks import KeyedTable
from ledgerline.sources.tables import Tables
from ledgerline.streaming import decode_stream as DS
from ledgerline.streaming import metrics_stream as MS
from ledgerline.streaming import projection as PR
from ledgerline.streaming import reservations as RS
from ledgerline.streaming import saga_stream as SS
from ledgerline.streaming import stateful as ST

# Query parameters (ranges inside the data's time span).
EVENTS_FROM, EVENTS_TO = M.parse_range("2024-01-03T00:00:00Z", "2024-01-10T12:00:00Z")
EMPTY_FROM, EMPTY_TO = M.parse_range("2023-06-01T00:00:00Z", "2023-06-02T00:00:00Z")
ORDERS_FROM, ORDERS_TO = M.parse_range("1996-01-01T00:00:00Z", "1997-01-01T00:00:00Z")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------------- metrics
@register("a1_hourly_metrics")
def q_a1_hourly_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(M.hourly_metrics(D.metric_events(t)))


@register("a1_hourly_metrics_created")
def q_a1_hourly_metrics_created(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(M.hourly_metrics(D.metric_events(t), statuses=["created"]))


@register("a4_top_product_rows")
def q_a4_top_product_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(M.product_window_rows(D.metric_event_items(t)))


@register("a4_top_product_rows_exploded")
def q_a4_top_product_rows_exploded(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(M.product_window_rows(M.explode_items(D.metric_events(t))))


def _in_range(t, from_ts, to_ts, table="events", col="ts"):
    """Tables whose event scan only reads the rows a contained-window query can use."""
    lo, hi = M.window_scan_bounds(from_ts, to_ts)
    c = F.col(col)
    return t.restrict(**{table: (c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.lit(hi).cast("timestamp_ntz"))})


@register("t2_hourly_series")
def q_t2_hourly_series(spark, sf_dir):
    t = _in_range(Tables(spark, sf_dir), EVENTS_FROM, EVENTS_TO)
    return present(M.hourly_series(M.hourly_metrics(D.metric_events(t)), EVENTS_FROM, EVENTS_TO))


@register("a6_revenue_summary")
def q_a6_revenue_summary(spark, sf_dir):
    t = _in_range(Tables(spark, sf_dir), EVENTS_FROM, EVENTS_TO)
    return present(M.revenue_summary(M.hourly_metrics(D.metric_events(t)), EVENTS_FROM, EVENTS_TO))


@register("a6_revenue_summary_empty")
def q_a6_revenue_summary_empty(spark, sf_dir):
    t = _in_range(Tables(spark, sf_dir), EMPTY_FROM, EMPTY_TO)
    return present(M.revenue_summary(M.hourly_metrics(D.metric_events(t)), EMPTY_FROM, EMPTY_TO))


@register("t1_top_products")
def q_t1_top_products(spark, sf_dir):
    t = _in_range(Tables(spark, sf_dir), EVENTS_FROM, EVENTS_TO)
    rows = M.product_window_rows(D.metric_event_items(t))
    return present(M.top_products(rows, EVENTS_FROM, EVENTS_TO))


@register("a4_order_product_rows")
def q_a4_order_product_rows(spark, sf_dir):
    """Window × product metrics of created orders, read straight from the line table.

    A line's order is created (it has a line), so lines ⋈ orders gives every
    created item with its event time — no journal and no item arrays needed.
    """
    items = D.created_lines(Tables(spark, sf_dir)).select(
        F.col("ts").alias("event_time"), "product_id", "quantity", "unit_price")
    return present(M.product_window_rows(items))


@register("t1_top_order_products")
def q_t1_top_order_products(spark, sf_dir):
    t = _in_range(Tables(spark, sf_dir), ORDERS_FROM, ORDERS_TO, "orders", "o_orderdate")
    items = D.created_lines(t).select(F.col("ts").alias("event_time"), "product_id", "quantity", "unit_price")
    return present(M.top_products(M.product_window_rows(items), ORDERS_FROM, ORDERS_TO, limit=25))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly metric series over the event stream (the `/analytics/hourly` answer)."""
    t = Tables(spark, sf_dir)
    metrics = M.hourly_metrics(D.metric_events(t))
    return present(M.hourly_series(metrics, datetime(2024, 1, 1), datetime(2024, 2, 1)))


# --------------------------------------------------------------------------- orders

AS_OF = datetime(1997, 6, 1)
LIST_STATUS, LIST_PAGE, LIST_SIZE = "SHIPPED", 2, 20
LIST_CUSTOMER = "370"
FIND_ORDER_ID = "1000"
JOURNAL_COLS = ["order_id", "seq", "event_type", "ts", "customer_id", "total_amount",
                "tracking_number", "carrier", "reason"]


def _summary(t):
    return O.project_order_summary(D.order_journal(t), D.order_created(t))


def _order_state(t):
    """The narrow state that pages and filters are decided on: no amounts, no items."""
    state = O.replay_order_state(D.order_journal(t, totals=False))
    return state.select("order_id", "customer_id", "status", "created_at")


def _summaries_of(t):
    """order ids → their read-model rows; the keys reach the scans of orders and lines."""
    def fetch(order_ids):
        keys = [int(k) for k in order_ids]
        return _summary(t.restrict(orders=F.col("o_orderkey").isin(keys), lineitem=F.col("l_orderkey").isin(keys)))
    return fetch


@register("s4_order_journal")
def q_s4_order_journal(spark, sf_dir):
    return present(D.order_journal(Tables(spark, sf_dir)).select(*JOURNAL_COLS))


LOST_PRIORITY, TWICE_PRIORITY = "2-HIGH", "3-MEDIUM"   # orders whose log ``damaged_journal`` breaks


def damaged_journal(t) -> DataFrame:
    """The journal with planted faults: event 1 of some orders is lost, event 0 of others stands twice (copy 0 and 1)."""
    j = D.order_journal(t, ("priority",)).select("order_id", "order_key", "seq", "event_type", "ts", "priority")
    kept = j.where(~((F.col("priority") == LOST_PRIORITY) & (F.col("seq") == 1)))
    copies = F.when((F.col("priority") == TWICE_PRIORITY) & (F.col("seq") == 0), 2).otherwise(1)
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))


@register("s4_journal_audit")
def q_s4_journal_audit(spark, sf_dir):
    """A log read in two runs, the second resumed at the stored position; its gaps and repeats."""
    base = scratch_path(spark, "journal")
    JN.write_journal(damaged_journal(Tables(spark, sf_dir)), f"{base}/log", "ts", "order_key", "seq", "copy")
    consumer = JN.JournalConsumer(spark, f"{base}/log", f"{base}/consumer")
    half = spark.read.parquet(f"{base}/log").count() // 2
    consumer.run(upto=half)
    consumer.run()
    return present(consumer.findings())


@register("w1_replay_order_state")
def q_w1_replay_order_state(spark, sf_dir):
    return present(O.replay_order_state(D.order_journal(Tables(spark, sf_dir))))


@register("w2_state_at")
def q_w2_state_at(spark, sf_dir):
    return present(O.state_at(D.order_journal(Tables(spark, sf_dir)), AS_OF))


@register("w3_illegal_transitions")
def q_w3_illegal_transitions(spark, sf_dir):
    return present(O.illegal_transitions(D.order_journal(Tables(spark, sf_dir))))


@register("k11_order_summary")
def q_k11_order_summary(spark, sf_dir):
    return present(_summary(Tables(spark, sf_dir)))


@register("p14_orders_by_status")
def q_p14_orders_by_status(spark, sf_dir):
    """The orders are chosen on the narrow state; amounts and items are read for the chosen ones."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders-by-status")
    (O.order_status_filter(_order_state(t), status="DELIVERED").select(F.col("order_id").cast("long").alias("order_key"))
     .write.parquet(path))
    chosen = t.semi(spark.read.schema("order_key long").parquet(path), orders="o_orderkey", lineitem="l_orderkey")
    return present(_summary(chosen))


@register("t3_list_orders")
def q_t3_list_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(O.list_orders_late(_order_state(t), _summaries_of(t), status=LIST_STATUS, page=LIST_PAGE, size=LIST_SIZE))


@register("t3_list_orders_customer")
def q_t3_list_orders_customer(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return present(O.list_orders_late(_order_state(t), _summaries_of(t), customer_id=LIST_CUSTOMER))


@register("p15_find_order")
def q_p15_find_order(spark, sf_dir):
    """Point lookup: the key predicate is placed on the base scans (row groups skipped by stats)."""
    t = Tables(spark, sf_dir)
    if FIND_ORDER_ID.isdigit():
        key = int(FIND_ORDER_ID)
        t = t.restrict(orders=F.col("o_orderkey") == key, lineitem=F.col("l_orderkey") == key)
    return present(O.find_order(_summary(t), FIND_ORDER_ID))


@register("j5_orphan_status_events")
def q_j5_orphan_status_events(spark, sf_dir):
    return present(O.orphan_status_events(D.order_journal(Tables(spark, sf_dir))).select(*JOURNAL_COLS))


@register("j5_status_updates")
def q_j5_status_updates(spark, sf_dir):
    return present(O.status_updates(D.order_journal(Tables(spark, sf_dir))).select(*JOURNAL_COLS))


@register("a1_order_hourly_metrics")
def q_a1_order_hourly_metrics(spark, sf_dir):
    """q1 + q8: every status event counts once more, enriched from Created."""
    return present(M.hourly_metrics(O.enrich_status_events(D.order_journal(Tables(spark, sf_dir)))))


@register("a1_order_hourly_metrics_created")
def q_a1_order_hourly_metrics_created(spark, sf_dir):
    return present(M.hourly_metrics(O.enrich_status_events(D.order_journal(Tables(spark, sf_dir))),
                                    statuses=["created"]))


# --------------------------------------------------------------------------- inventory


@register("k1_stock_levels")
def q_k1_stock_levels(spark, sf_dir):
    return present(I.apply_stock_events(D.stock_event_ledger(Tables(spark, sf_dir))))


@register("k1_open_reservations")
def q_k1_open_reservations(spark, sf_dir):
    return present(I.open_reservations(D.stock_event_ledger(Tables(spark, sf_dir))))


@register("k6_inventory_snapshot")
def q_k6_inventory_snapshot(spark, sf_dir):
    t = Tables(spark, sf_dir)
    snap = I.inventory_snapshot(D.stock_event_ledger(t))
    names = D.stock_initial(t).select("product_id", "product_name")
    return present(snap.join(names, "product_id", "left"))


@register("j3_order_reservation_outcome")
def q_j3_order_reservation_outcome(spark, sf_dir):
    return present(I.order_reservation_outcome(D.item_results_initial(Tables(spark, sf_dir))))


@register("a9_failure_reasons")
def q_a9_failure_reasons(spark, sf_dir):
    out = I.order_reservation_outcome(D.item_results_initial(Tables(spark, sf_dir)))
    return present(out.where(~F.col("reserved")).select("order_id", "reason"))


@register("j4_compensation_set")
def q_j4_compensation_set(spark, sf_dir):
    items = D.item_results_initial(Tables(spark, sf_dir))
    return present(I.compensation_set(items).select("order_id", "line_no", "product_id", "quantity"))


def _fold_results(t):
    return I.apply_stock_commands(D.stock_commands(t))


@register("k2_reserve_stock")
def q_k2_reserve_stock(spark, sf_dir):
    """K2–K5 and K9: the whole stock command log folded per product."""
    return present(_fold_results(Tables(spark, sf_dir)))


@register("k2_reserve_stock_split")
def q_k2_reserve_stock_split(spark, sf_dir):
    """The same command log with every product split over range partitions (proof by prefix sums, fold of the rest)."""
    return present(SF.apply_stock_commands_split(D.stock_commands(Tables(spark, sf_dir))))


@register("k2_stock_after_fold")
def q_k2_stock_after_fold(spark, sf_dir):
    """K1 over the fold's ledger; the fold feeds two aggregates, so it is checkpointed once."""
    ensure_checkpoint_dir(spark)
    results = _fold_results(Tables(spark, sf_dir)).checkpoint(eager=True)
    return present(I.apply_stock_events(I.ledger_from_results(results)))


def _k7(t, materialize: bool = False):
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    return I.reserve_orders(lines, D.stock_initial(t), D.EPOCH, materialize=materialize)


@register("k7_reserve_orders")
def q_k7_reserve_orders(spark, sf_dir):
    return present(_k7(Tables(spark, sf_dir))["outcome"])


@register("k7_stock_after_compensation")
def q_k7_stock_after_compensation(spark, sf_dir):
    return present(_k7(Tables(spark, sf_dir), materialize=True)["stock"])


@register("k8_batch_reserve")
def q_k8_batch_reserve(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    return present(I.batch_reserve(lines, D.stock_initial(t), D.EPOCH))


@register("k9_release_confirm_orders")
def q_k9_release_confirm_orders(spark, sf_dir):
    res = _fold_results(Tables(spark, sf_dir))
    return present(res.where(F.col("kind").isin("release", "confirm")))


@register("s8_inventory_event_records")
def q_s8_inventory_event_records(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k7 = _k7(t)
    when = D.order_headers(t).select("order_id", F.col("created_at").alias("ts"))
    return I.stock_events_records(k7["outcome"].join(when, "order_id"))


# --------------------------------------------------------------------------- order commands


@register("k10_order_commands")
def q_k10_order_commands(spark, sf_dir):
    j = D.order_journal(Tables(spark, sf_dir))
    return present(K.handle_order_commands(K.commands_from_journal(j)))


# --------------------------------------------------------------------------- saga

PAYMENT_DECLINED = "Insufficient funds"   # ours: payment fails for a customer in debit


def saga_inputs(t):
    """Saga events derived from the tables (all SQL-expressible rules), in one pass.

    One row per created order (Created ⋈ reservation outcome ⋈ customer) is
    exploded into its saga events, so the journal and the outcome are
    computed once rather than once per event kind.
    """
    created = (D.order_journal(t).where(F.col("event_type") == "OrderCreated")
               .select("order_id", "ts", "customer_id", "total_amount"))
    outcome = I.order_reservation_outcome(D.item_results_initial(t)).select("order_id", "reserved", "reason")
    acct = D.customers(t).select("customer_id", "acctbal")
    base = created.join(outcome, "order_id").join(acct, "customer_id", "left")
    t1, t2 = F.col("ts") + F.expr("INTERVAL 1 MINUTE"), F.col("ts") + F.expr("INTERVAL 2 MINUTE")
    paid_ok = F.col("acctbal") >= 0
    no_money, no_text = F.lit(None).cast("decimal(19,4)"), F.lit(None).cast("string")

    def ev(cond, etype, ts, customer=no_text, total=no_money, reason=no_text):
        return F.when(cond, F.struct(F.lit(etype).alias("event_type"), ts.alias("ts"),
                                     customer.alias("customer_id"), total.alias("total_amount"),
                                     reason.alias("reason")))

    events = F.array_compact(F.array(
        ev(F.lit(True), S.CREATED, F.col("ts"), F.col("customer_id"), F.col("total_amount")),
        ev(F.col("reserved"), S.RESERVED, t1),
        ev(~F.col("reserved"), S.INV_FAILED, t1, reason=F.col("reason")),
        ev(F.col("reserved") & paid_ok, S.PAID, t2),
        ev(F.col("reserved") & (~paid_ok | F.col("acctbal").isNull()), S.PAY_FAILED, t2,
           reason=F.lit(PAYMENT_DECLINED)),
    ))
    return base.select("order_id", F.explode(events).alias("e")).select("order_id", "e.*").select(*S.SAGA_EVENT_COLS)


@register("j2_saga_correlate")
def q_j2_saga_correlate(spark, sf_dir):
    return present(S.saga_correlate(saga_inputs(Tables(spark, sf_dir))))


@register("k12_saga_status")
def q_k12_saga_status(spark, sf_dir):
    return present(S.saga_status(S.saga_correlate(saga_inputs(Tables(spark, sf_dir)))))


@register("k13_saga_commands")
def q_k13_saga_commands(spark, sf_dir):
    return present(S.saga_commands(S.saga_correlate(saga_inputs(Tables(spark, sf_dir)))))


# --------------------------------------------------------------------------- order ⟕ stock


def order_documents(t):
    """Each order as the JSON document a client receives: its id and its items.

    Built from the Created events (the items never change afterwards), so the
    SKU queries do not need the replayed status.
    """
    c = D.order_created(t)
    doc = F.concat(F.lit('{"orderId":"'), F.col("order_id"), F.lit('","items":'),
                   items_to_json("items"), F.lit("}"))
    return c.select("order_id", doc.alias("doc"))


@register("p13_extract_skus")
def q_p13_extract_skus(spark, sf_dir):
    docs = order_documents(Tables(spark, sf_dir))
    return present(docs.select("order_id", F.posexplode(extract_skus("doc")).alias("pos", "sku")))


@register("a8_distinct_skus")
def q_a8_distinct_skus(spark, sf_dir):
    return present(V.distinct_skus(order_documents(Tables(spark, sf_dir))))


@register("j1_order_with_stock")
def q_j1_order_with_stock(spark, sf_dir):
    t = Tables(spark, sf_dir)
    stock = I.apply_stock_events(D.stock_event_ledger(t))
    return present(V.order_with_stock(order_documents(t), stock))


# --------------------------------------------------------------------------- notifications


def _low_stock(t):
    snap = I.apply_stock_events(D.stock_event_ledger(t))
    names = D.stock_initial(t).select("product_id", "product_name")
    return N.low_stock_events(snap.join(names, "product_id", "left"))


@register("n1_order_notifications")
def q_n1_order_notifications(spark, sf_dir):
    return present(N.order_notifications(D.notification_events(Tables(spark, sf_dir))))


@register("n1_order_notifications_default")
def q_n1_order_notifications_default(spark, sf_dir):
    return present(N.order_notifications(D.notification_events(Tables(spark, sf_dir)), use_default=True))


@register("n2_webhook_payloads")
def q_n2_webhook_payloads(spark, sf_dir):
    ev = N.route_notifications(D.notification_events(Tables(spark, sf_dir)))["order"]
    return present(N.webhook_payloads(ev))


@register("n4_low_stock_events")
def q_n4_low_stock_events(spark, sf_dir):
    return present(_low_stock(Tables(spark, sf_dir)))


@register("n3_low_stock_notifications")
def q_n3_low_stock_notifications(spark, sf_dir):
    return present(N.low_stock_notifications(_low_stock(Tables(spark, sf_dir))))


@register("n5_route_notifications")
def q_n5_route_notifications(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = D.notification_events(t).select("event_type", F.col("order_id").alias("entity_id"))
    low = _low_stock(t).select(F.lit(N.config.NOTIFY_INVENTORY_TYPE).alias("event_type"),
                               F.col("product_id").alias("entity_id"))
    return present(N.with_route(orders.unionByName(low)))


# --------------------------------------------------------------------------- rate audits

USER_LIMIT, USER_SECONDS = 2, 3600          # scaled-down per-user fixed window
GLOBAL_LIMIT, GLOBAL_SECONDS = 25, 3600     # scaled-down unkeyed fixed window
SLIDING_LIMIT, SLIDING_SECONDS, SLIDING_SEGMENTS = 25, 3600, 6


@register("k15_fixed_window_breaches_user")
def q_k15_user(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return present(R.fixed_window_breaches(ev, USER_LIMIT, USER_SECONDS, key="user_id"))


@register("k15_fixed_window_breaches_global")
def q_k15_global(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return present(R.fixed_window_breaches(ev, GLOBAL_LIMIT, GLOBAL_SECONDS))


@register("k16_sliding_window_breaches")
def q_k16_sliding(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return present(R.sliding_window_breaches(ev, SLIDING_LIMIT, SLIDING_SECONDS, SLIDING_SEGMENTS))


# --------------------------------------------------------------------------- topic records / parsing


def _parsed(t):
    return P.parse_order_event(D.order_topic_records(t))


@register("p1_parse_order_events")
def q_p1_parse_order_events(spark, sf_dir):
    p = _parsed(Tables(spark, sf_dir)).where("ok")
    return present(p.select("topic", "key", "order_id", "customer_id", "total_amount", "status", "event_time",
                            F.size("items").alias("n_items"), order_total("items").alias("items_total")))


@register("p3_quarantine")
def q_p3_quarantine(spark, sf_dir):
    _, bad = P.quarantine(_parsed(Tables(spark, sf_dir)))
    return present(bad.select("topic", "key", "error"))


@register("p3_error_counts")
def q_p3_error_counts(spark, sf_dir):
    return present(P.event_type_counts(_parsed(Tables(spark, sf_dir))))


@register("s9_dead_letter")
def q_s9_dead_letter(spark, sf_dir):
    return present(N.dead_letter(_parsed(Tables(spark, sf_dir))).select("topic", "key", "reason"))


@register("p1_hourly_metrics_from_topics")
def q_p1_hourly_metrics_from_topics(spark, sf_dir):
    valid, _ = P.quarantine(_parsed(Tables(spark, sf_dir)))
    return present(M.hourly_metrics(valid))


@register("u1_union_topics")
def q_u1_union_topics(spark, sf_dir):
    recs = D.order_topic_records(Tables(spark, sf_dir))
    return present(recs.where(F.col("topic").isin(N.config.ANALYTICS_TOPICS)).select("topic", "key", "offset"))


@register("s1_read_order_topics")
def q_s1_read_order_topics(spark, sf_dir):
    """Records written as a record table, read back through the S1 reader."""
    path = scratch_path(spark, "order-topics")
    D.order_topic_records(Tables(spark, sf_dir)).write.mode("overwrite").parquet(path)
    return present(TP.read_order_topics(spark, path).select("topic", "key", "offset"))


def _envelopes(t):
    return TP.publish_order_events(D.order_journal(t, contents=True))


@register("s10_publish_order_events")
def q_s10_publish_order_events(spark, sf_dir):
    return present(_envelopes(Tables(spark, sf_dir)))


@register("p4_parse_envelopes")
def q_p4_parse_envelopes(spark, sf_dir):
    env = P.parse_envelope(_envelopes(Tables(spark, sf_dir)))
    return present(env.select("event_type", "order_id", F.size("items").alias("n_items"), "ok", "error"))


@register("p5_route_commands")
def q_p5_route_commands(spark, sf_dir):
    routes = P.route_by_event_type(P.parse_envelope(_envelopes(Tables(spark, sf_dir))))
    return present(routes["commands"].drop("offset", "timestamp"))


@register("p5_empty_item_events")
def q_p5_empty_item_events(spark, sf_dir):
    routes = P.route_by_event_type(P.parse_envelope(_envelopes(Tables(spark, sf_dir))))
    return present(routes["empty"].select("event_type", "order_id"))


@register("k9_recovered_commands")
def q_k9_recovered_commands(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "parsed-envelopes")     # read twice below
    env = P.parse_envelope(_envelopes(t)).drop("value")
    env.write.parquet(path)
    env = spark.read.schema(env.schema).parquet(path)
    created = env.where(F.col("event_type") == "ORDER_CREATED").select("order_id", "items")
    fixed = P.recover_items(env.where(F.col("event_type").isin("ORDER_CANCELLED", "ORDER_CONFIRMED")), created)
    return present(P.route_by_event_type(fixed)["commands"].drop("offset", "timestamp"))


@register("p11_validate_orders")
def q_p11_validate_orders(spark, sf_dir):
    """P11 on the tables: per-order aggregates over the line table (no item arrays)."""
    t = Tables(spark, sf_dir)
    headers = D.order_headers(t).join(D.customers(t).select("customer_id", "shipping_address"),
                                      "customer_id", "left").select("order_id", "customer_id", "shipping_address")
    v = P.validate_order_lines(headers, D.order_lines(t))
    return present(v.select("order_id", "valid", F.array_join("reasons", ",").alias("reasons"), "total_amount"))


@register("p12_items_json")
def q_p12_items_json(spark, sf_dir):
    c = D.order_created(Tables(spark, sf_dir))
    return present(c.select("order_id", items_to_json("items").alias("items_json")))


# --------------------------------------------------------------------------- streaming


def _metrics_streams(spark, sf_dir):
    ev = MS.stream_table(spark, sf_dir, "events")
    base = scratch_path(spark, "metrics-stream")
    return MS.run_metrics_stream(spark, D.normalise_events(ev), D.event_items(ev), base, watermark="1 hour")


@register("k14_hourly_metrics_stream")
def q_k14_hourly_metrics_stream(spark, sf_dir):
    hourly, _ = _metrics_streams(spark, sf_dir)
    return present(hourly.read(spark))


@register("k14_top_products_stream")
def q_k14_top_products_stream(spark, sf_dir):
    _, top = _metrics_streams(spark, sf_dir)
    return present(top.read(spark))


def _run_stream_to_parquet(spark, stream_df: DataFrame, name: str, start=None) -> DataFrame:
    base = scratch_path(spark, name)
    writer = (stream_df.writeStream.outputMode("append").format("parquet")
              .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
              .trigger(availableNow=True))
    q = start(spark, writer) if start else writer.start()
    q.awaitTermination()
    return spark.read.schema(stream_df.schema).parquet(f"{base}/out")


def _as_stream(spark, df: DataFrame, name: str) -> DataFrame:
    """Write a derived log as record files, then read it back as a stream."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


SLICE_ROWS = 4_000_000                   # records of a delivered file at most, about
ROW_GROUP = 8 << 20                      # bytes of its row groups: a file is a trigger, and several tasks are to read it


def deliver_in_order(df: DataFrame, ts: str, path: str, slices: int) -> None:
    """Write ``df`` as at most ``slices`` files in the order of ``ts`` (equal times in one file, missing ones in the first): one pass
    over range partitions, whose files then get modification times in that order, by which a file stream takes them."""
    spark = df.sparkSession
    df.repartitionByRange(slices, ts).write.mode("append").option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    last = max((f.getModificationTime() for f in files), default=0) // 1000 * 1000
    for i, f in enumerate(files):
        fs.setTimes(f.getPath(), last - 1000 * (len(files) - 1 - i), -1)
    times = [fs.getFileStatus(f.getPath()).getModificationTime() for f in files]
    if times != sorted(set(times)):
        raise RuntimeError(f"the files of {path} cannot be put in order: its file system keeps no modification times")


def _as_ordered_stream(spark, df: DataFrame, name: str) -> DataFrame:
    """A derived log read back as a stream whose triggers follow its time: one file each, by a topic's order."""
    base = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(f"{base}/log")
    log = spark.read.schema(df.schema).parquet(f"{base}/log")
    deliver_in_order(log, "ts", f"{base}/files", max(2, -(-log.count() // SLICE_ROWS)))
    drop_folder(spark, f"{base}/log")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/files")


@register("k2_reserve_stock_stream")
def q_k2_reserve_stock_stream(spark, sf_dir):
    cmds = _as_ordered_stream(spark, D.stock_commands(Tables(spark, sf_dir)), "stock-commands")
    return present(_run_stream_to_parquet(spark, ST.stock_fold_stream(cmds), "stock-fold-stream", ST.start_with_rocksdb))


@register("k10_order_commands_stream")
def q_k10_order_commands_stream(spark, sf_dir):
    j = D.order_journal(Tables(spark, sf_dir))
    cmds = _as_ordered_stream(spark, K.commands_from_journal(j), "order-commands")
    return present(_run_stream_to_parquet(spark, ST.order_command_stream(cmds), "order-command-stream"))


# --------------------------------------------------------------------------- more source / sink / aggregate forms
CHUNK_EVENTS = N.config.BATCH_EVENTS     # A10: chunks of 200 consecutive events (by offset)


@register("a10_batch_partial_metrics")
def q_a10_batch_partial_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = D.metric_events(t, keep=("event_id",)).withColumn(
        "chunk", F.floor(F.col("event_id") / F.lit(CHUNK_EVENTS)).cast("long"))
    return present(M.batch_partial_metrics(ev, "chunk"))


FLUSH_SECONDS = 50_400                   # A10 query: fourteen hours, about 200 events of the small tables, so both cuts happen


@register("a10_flush_partial_metrics")
def q_a10_flush_partial_metrics(spark, sf_dir):
    """A10: partial window totals of chunks cut after 200 events, or a flush interval after the chunk's first event."""
    ev = D.metric_events(Tables(spark, sf_dir), keep=("event_id",)).select("event_id", "event_time", "total_amount")
    chunked = B.cut_batches(ev, CHUNK_EVENTS, FLUSH_SECONDS, offset="event_id")
    return present(M.batch_partial_metrics(chunked, "chunk_start"))


@register("k6_inventory_reservation_map")
def q_k6_inventory_reservation_map(spark, sf_dir):
    """K6's reservations map as flattened entries (product, order → quantity) with the snapshot.

    One row per map entry: a product with a third of all reservations is
    spread over many rows and tasks instead of one map value.
    """
    ledger = D.stock_event_ledger(Tables(spark, sf_dir))
    snap = I.apply_stock_events(ledger).select("product_id", "available", "reserved", "total")
    entries = I.open_reservations(ledger)
    return present(entries.join(snap, "product_id"))


@register("s2_read_order_envelopes")
def q_s2_read_order_envelopes(spark, sf_dir):
    """Envelope records written as a record table and read back through the S2 reader."""
    path = scratch_path(spark, "order-events")
    _envelopes(Tables(spark, sf_dir)).write.mode("overwrite").parquet(path)
    env = P.parse_envelope(TP.read_order_envelopes(spark, path))
    return present(env.select("topic", "key", "event_type", "ok"))


DAMAGED_PRIORITY = "4-NOT SPECIFIED"     # orders whose records ``damaged`` breaks: confirmations cut off, shipments without OrderId


def notification_records(t, damaged: bool = False):
    """order-events / inventory-events records as the notification service reads them (key = type)."""
    ev = D.notification_events(t, ("priority",))
    broken = F.lit(damaged) & (F.col("priority") == DAMAGED_PRIORITY)
    order_json = F.to_json(F.struct(
        F.when(~(broken & (F.col("event_type") == "OrderShipped")), F.col("order_id")).alias("OrderId"), F.col("customer_email").alias("CustomerEmail"),
        F.col("status").alias("Status"), F.col("tracking_number").alias("TrackingNumber"),
        F.col("cancellation_reason").alias("CancellationReason"), F.col("webhook_url").alias("WebhookUrl")))
    order_json = F.when(broken & (F.col("event_type") == "OrderConfirmed"), F.substring(order_json, 1, 16)).otherwise(order_json)
    orders = ev.select(F.lit(N.config.ORDER_EVENTS_TOPIC).alias("topic"), F.col("event_type").alias("key"),
                       order_json.alias("value"), F.lit(0).alias("partition"),
                       F.lit(None).cast("long").alias("offset"), F.col("ts").alias("timestamp"))
    low = _low_stock(t)
    low_json = F.to_json(F.struct(
        F.col("product_id").alias("ProductId"), F.col("product_name").alias("ProductName"),
        F.col("remaining_stock").alias("RemainingStock"),
        F.col("warehouse_manager_email").alias("WarehouseManagerEmail")))
    inv = low.select(F.lit(N.config.INVENTORY_EVENTS_TOPIC).alias("topic"),
                     F.lit(N.config.NOTIFY_INVENTORY_TYPE).alias("key"), low_json.alias("value"),
                     F.lit(0).alias("partition"), F.lit(None).cast("long").alias("offset"),
                     F.lit(None).cast("timestamp").alias("timestamp"))
    return orders.unionByName(inv)


@register("s3_read_notification_events")
def q_s3_read_notification_events(spark, sf_dir):
    """Notification records read back through S3, decoded and turned into e-mails (N5 → N1)."""
    path = scratch_path(spark, "notification-records")
    notification_records(Tables(spark, sf_dir)).write.mode("overwrite").parquet(path)
    base = scratch_path(spark, "notification-sinks")
    DS.write_notifications(spark, TP.read_notification_events(spark, path), base)
    return present(DS.read_notifications(spark, base))


@register("k11_order_summary_stream")
def q_k11_order_summary_stream(spark, sf_dir):
    """The read model maintained by a stream of journal events (per-batch partial replays)."""
    j = D.order_journal(Tables(spark, sf_dir)).select(*JOURNAL_COLS)
    stream = _as_stream(spark, j, "journal")
    base = scratch_path(spark, "order-summary")
    PR.start_order_summary_stream(stream, f"{base}/partials", f"{base}/ckpt").awaitTermination()
    return present(PR.read_order_summary(spark, f"{base}/partials"))


@register("k12_saga_status_stream")
def q_k12_saga_status_stream(spark, sf_dir):
    """Saga state maintained by a stream of saga events (per-batch partial correlation)."""
    ev = _as_stream(spark, saga_inputs(Tables(spark, sf_dir)), "saga-events")
    base = scratch_path(spark, "saga")
    SS.start_saga_stream(ev, f"{base}/partials", f"{base}/ckpt").awaitTermination()
    return present(SS.read_saga_status(spark, f"{base}/partials"))


@register("k7_reserve_orders_stream")
def q_k7_reserve_orders_stream(spark, sf_dir):
    """K7 over a stream of order records (per micro-batch all-or-nothing, state in keyed tables)."""
    t = Tables(spark, sf_dir)
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    stream = _as_stream(spark, RS.order_records(lines), "order-records")
    base = scratch_path(spark, "reservations")
    RS.start_reservation_stream(spark, stream, D.stock_initial(t), f"{base}/state", f"{base}/ckpt").awaitTermination()
    return present(RS.read_outcomes(spark, f"{base}/state").drop("batch_id"))


@register("k9_stock_commands_stream")
def q_k9_stock_commands_stream(spark, sf_dir):
    """The inventory consumer as a stream: envelopes → decode → route → items recovered → stock."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "order-events")
    _envelopes(t).write.mode("overwrite").option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    base = scratch_path(spark, "inventory")
    RS.start_inventory_stream(spark, TP.read_order_envelopes(spark, path, stream=True), D.stock_initial(t),
                              f"{base}/state", f"{base}/ckpt").awaitTermination()
    return present(RS.read_stock(spark, f"{base}/state"))


@register("s9_dead_letter_stream")
def q_s9_dead_letter_stream(spark, sf_dir):
    """Topic records decoded as a stream; dead letters written as the second sink."""
    recs = _as_stream(spark, D.order_topic_records(Tables(spark, sf_dir)), "order-topic-records")
    base = scratch_path(spark, "decode")
    DS.start_decode_stream(spark, recs, base, f"{base}/ckpt").awaitTermination()
    return present(spark.read.parquet(f"{base}/dead_letters").select("topic", "key", "reason"))


@register("n1_order_notifications_stream")
def q_n1_order_notifications_stream(spark, sf_dir):
    """Notification e-mails derived from a stream of notification records."""
    recs = _as_stream(spark, notification_records(Tables(spark, sf_dir)), "notification-records")
    base = scratch_path(spark, "notifications")
    DS.start_notification_stream(spark, recs, base, f"{base}/ckpt").awaitTermination()
    return present(DS.read_notifications(spark, base))


@register("s9_notification_sinks_stream")
def q_s9_notification_sinks_stream(spark, sf_dir):
    """Where a stream of notification records, some of them damaged, ends up: rows by sink, type and reason."""
    recs = _as_stream(spark, notification_records(Tables(spark, sf_dir), damaged=True), "notification-records")
    base = scratch_path(spark, "notification-sinks")
    DS.start_notification_stream(spark, recs, base, f"{base}/ckpt").awaitTermination()
    none = F.lit(None).cast("string")
    rows = {"notifications": ("event_type", none), "dead_letters": ("key", F.col("reason")), "others": ("key", F.col("route"))}
    frames = [DS.read_notifications(spark, base, sink).select(F.lit(sink).alias("sink"), F.col(key).alias("event_type"), reason.alias("reason"))
              for sink, (key, reason) in rows.items()]
    return present(P.union_topics(*frames).groupBy("sink", "event_type", "reason").agg(F.count("*").alias("records")))


@register("k15_fixed_window_breaches_stream")
def q_k15_fixed_window_breaches_stream(spark, sf_dir):
    """K15 per user as a stream: running window counts (update mode) in a keyed table, read against the limit."""
    counts = R.fixed_window_counts_stream(MS.stream_table(spark, sf_dir, "events"), USER_SECONDS, key="user_id")
    return present(R.breaches(run_rate_stream(spark, counts, scratch_path(spark, "rate-audit")), USER_LIMIT))


def run_rate_stream(spark, counts: DataFrame, base: str) -> DataFrame:
    """The counts table after the stream has run over what is available."""
    keys = [c for c in counts.columns if c != "request_count"]
    counted = KeyedTable(f"{base}/counts", keys, counts.schema)
    counted.ensure(spark)
    MS.start_upsert(counts, counted, f"{base}/ckpt").awaitTermination()
    return counted.read(spark)
