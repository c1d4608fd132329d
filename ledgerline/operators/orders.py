"""Event-sourced order state and its read model.

The journal has one row per event: order_id, seq (dense per order, from 0),
event_type, ts and the event's own fields (customer_id/total_amount on
Created, tracking_number/carrier on Shipped, reason on Cancelled).

Replays are aggregates (``max_by`` over seq), not window functions, so they
get a partial aggregate before the shuffle and a hot order cannot pile up in
one task; the transition check pairs events with a self-join on
(order_id, seq - 1) instead of ``lag`` for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.functions.jsonfmt import items_to_json

EVENT_STATUS = config.EVENT_STATUS
LEGAL_TRANSITIONS = config.LEGAL_TRANSITIONS


def event_status(event_type="event_type") -> Column:
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for et, st in EVENT_STATUS.items():
        expr = F.when(c == et, F.lit(st)) if expr is None else expr.when(c == et, F.lit(st))
    return expr


def _last_where(value: str, cond: Column) -> Column:
    """Value of the highest-seq event satisfying ``cond`` (null if none)."""
    return F.max_by(F.when(cond, F.col(value)), F.when(cond, F.col("seq")))


def replay_order_state(journal: DataFrame) -> DataFrame:
    """Aggregate state after all events of each created order."""
    created = F.col("event_type") == "OrderCreated"
    shipped = F.col("event_type") == "OrderShipped"
    state = (journal.groupBy("order_id")
             .agg(F.max_by(event_status(), "seq").alias("status"),
                  F.max("seq").alias("last_seq"),
                  F.max_by("ts", "seq").alias("updated_at"),
                  _last_where("customer_id", created).alias("customer_id"),
                  _last_where("total_amount", created).alias("total_amount"),
                  _last_where("ts", created).alias("created_at"),
                  _last_where("tracking_number", shipped).alias("tracking_number"),
                  _last_where("carrier", shipped).alias("carrier"),
                  F.max(created.cast("int")).alias("has_created")))
    # an aggregate exists only once it was created (orphan events are skipped)
    return state.where(F.col("has_created") == 1).drop("has_created")


def state_at(journal: DataFrame, as_of) -> DataFrame:
    """State as of an instant = replay of the log prefix with ts <= as_of."""
    return replay_order_state(journal.where(F.col("ts") <= F.lit(as_of)))


def illegal_transitions(journal: DataFrame) -> DataFrame:
    """Events whose (status before → status after) is not a legal transition."""
    cur = journal.select("order_id", "seq", "event_type", "ts", event_status().alias("to_status"))
    prev = journal.select("order_id", (F.col("seq") + 1).alias("seq"), event_status().alias("from_status"))
    pairs = cur.join(prev, ["order_id", "seq"], "left")
    legal = F.array(*[F.lit(f"{a or ''}>{b}") for a, b in LEGAL_TRANSITIONS])
    key = F.concat(F.coalesce(F.col("from_status"), F.lit("")), F.lit(">"), F.col("to_status"))
    return (pairs.where(~F.array_contains(legal, key))
            .select("order_id", "seq", "event_type", "ts", "from_status", "to_status"))


def orphan_status_events(journal: DataFrame) -> DataFrame:
    """J5 (orphans): status events of orders that were never created."""
    created = journal.where(F.col("event_type") == "OrderCreated").select("order_id")
    return journal.where(F.col("event_type") != "OrderCreated").join(created, "order_id", "left_anti")


def status_updates(journal: DataFrame) -> DataFrame:
    """J5 (updates): status events of existing orders (inner join)."""
    created = journal.where(F.col("event_type") == "OrderCreated").select("order_id").distinct()
    return journal.where(F.col("event_type") != "OrderCreated").join(created, "order_id", "inner")


def enrich_status_events(journal: DataFrame) -> DataFrame:
    """q8: status events get customer and amount of their order's Created event.

    Returns the normalised analytics shape; orphans keep null customer/amount
    and are therefore dropped, as the analytics decoder would drop them.
    """
    created = (journal.where(F.col("event_type") == "OrderCreated")
               .select("order_id", F.col("customer_id").alias("c_customer_id"),
                       F.col("total_amount").alias("c_total_amount")))
    ev = journal.join(created, "order_id", "left")
    status = F.lower(F.regexp_replace("event_type", "^Order", ""))
    return (ev.where(F.col("c_customer_id").isNotNull())
            .select("order_id", F.col("c_customer_id").alias("customer_id"),
                    F.col("c_total_amount").alias("total_amount"),
                    status.alias("status"), F.col("ts").alias("event_time")))


def project_order_summary(journal: DataFrame, created: DataFrame | None = None) -> DataFrame:
    """The read model; Created inserts PENDING, later events update.

    ``created`` (optional) supplies items and shipping address of the Created
    events (order_id, items, shipping_address) for ``items_json``.
    """
    st = replay_order_state(journal)
    out = st.select("order_id", "customer_id", "status", "total_amount", "tracking_number",
                    "carrier", "created_at", "updated_at", "last_seq")
    if created is not None:
        extra = created.select("order_id", items_to_json("items").alias("items_json"), "shipping_address")
        out = out.join(extra, "order_id", "left")
    return out


def order_status_filter(summary: DataFrame, customer_id: str | None = None,
                        status: str | None = None) -> DataFrame:
    """Optional conjunctive filter on customer and status."""
    if customer_id is not None:
        summary = summary.where(F.col("customer_id") == F.lit(customer_id))
    if status is not None:
        summary = summary.where(F.col("status") == F.lit(status))
    return summary


NEWEST_FIRST = ("created_at", "order_id")
MAX_PAGE = 1000                          # orders of a page whose keys may come to the driver


def list_orders(summary: DataFrame, customer_id: str | None = None, status: str | None = None,
                page: int = 0, size: int = config.PAGE_SIZE, after: tuple | None = None) -> DataFrame:
    """Newest first, one page; order_id breaks ties (q18).

    ``after`` is the (created_at, order_id) of the last order seen: the page begins behind it, whatever was
    added before, and each task keeps ``size`` rows, however deep the page lies. ``page`` counts from there.
    """
    if page < 0 or size < 1:
        raise ValueError("page must be >= 0 and size >= 1")
    rows = order_status_filter(summary, customer_id, status)
    if after is not None:
        at, last = F.col("created_at"), F.lit(after[0])
        rows = rows.where((at < last) | ((at == last) & (F.col("order_id") < F.lit(after[1]))))
    return (rows.orderBy(*(F.col(c).desc() for c in NEWEST_FIRST))
            .offset(page * size).limit(size))


def list_orders_late(state: DataFrame, details: Callable[[list[str]], DataFrame], size: int = config.PAGE_SIZE,
                     **page) -> DataFrame:
    """T3 with late materialisation: the page is found on the narrow ``state``, then its orders are fetched.

    ``state`` needs order_id, customer_id, status and created_at; ``details(order_ids)`` gives the full rows of
    those orders. Only the page's keys come to the driver, at most ``size`` (1 to ``MAX_PAGE``) of them, so that the
    scans behind ``details`` can skip by key. Other arguments as ``list_orders``.
    """
    if size > MAX_PAGE:
        raise ValueError(f"a page holds at most {MAX_PAGE} orders")
    keys = [r["order_id"] for r in list_orders(state, size=size, **page).select("order_id").collect()]
    return details(keys).orderBy(*(F.col(c).desc() for c in NEWEST_FIRST))


def find_order(summary: DataFrame, order_id: str, check: bool = False) -> DataFrame:
    """Point lookup; with ``check`` a missing order raises ``LookupError``."""
    out = summary.where(F.col("order_id") == F.lit(order_id))
    if check and out.limit(1).count() == 0:
        raise LookupError(f"Order not found: {order_id}")
    return out
