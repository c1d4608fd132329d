"""Notification derivation (N1–N5) and dead letters.

Routing is by the record key (the event type); four order types and the
low-stock type are handled, anything else goes to a side output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.functions.jsonfmt import json_string

WAREHOUSE_MANAGER_EMAIL = "warehouse@example.com"   # ours: N4 recipients


def _fmt(template: str, values: dict[str, Column]) -> Column:
    """C#-style interpolation: ``{name}`` → value, null → empty string."""
    parts, rest = [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(pre), F.coalesce(values[name].cast("string"), F.lit(""))]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def route_notifications(events: DataFrame, key: str = "event_type") -> dict[str, DataFrame]:
    """Split by key into order / inventory / unknown (q17: delivered is unknown)."""
    k = F.col(key)
    return {"order": events.where(k.isin(config.NOTIFY_ORDER_TYPES)),
            "inventory": events.where(k == config.NOTIFY_INVENTORY_TYPE),
            "unknown": events.where(~k.isin(config.NOTIFY_ORDER_TYPES + [config.NOTIFY_INVENTORY_TYPE])
                                    | k.isNull())}


def with_route(events: DataFrame, key: str = "event_type") -> DataFrame:
    """N5 in one pass: every event with its ``route`` (order, inventory or unknown)."""
    k = F.col(key)
    return events.withColumn("route", F.when(k.isin(config.NOTIFY_ORDER_TYPES), F.lit("order"))
                             .when(k == config.NOTIFY_INVENTORY_TYPE, F.lit("inventory")).otherwise(F.lit("unknown")))


def order_notifications(events: DataFrame, use_default: bool = False) -> DataFrame:
    """Email rows (to, subject, body) per order event.

    ``events``: event_type, order_id, customer_email, status, tracking_number,
    cancellation_reason. Unknown types get the default template only with
    ``use_default`` (q17); otherwise they are dropped here (see N5).
    """
    vals = {"id": F.col("order_id"), "tracking": F.col("tracking_number"),
            "reason": F.col("cancellation_reason"), "type": F.col("event_type")}
    subject = body = None
    for etype, (subj, text) in config.NOTIFY_TEMPLATES.items():
        cond = F.col("event_type") == etype
        subject = F.when(cond, F.lit(subj)) if subject is None else subject.when(cond, F.lit(subj))
        body = F.when(cond, _fmt(text, vals)) if body is None else body.when(cond, _fmt(text, vals))
    dsubj, dbody = config.NOTIFY_DEFAULT_TEMPLATE
    subject, body = subject.otherwise(F.lit(dsubj)), body.otherwise(_fmt(dbody, vals))
    if not use_default:
        events = events.where(F.col("event_type").isin(config.NOTIFY_ORDER_TYPES))
    return events.select("event_type", "order_id", F.col("customer_email").alias("to"),
                         subject.alias("subject"), body.alias("body"))


def webhook_payloads(events: DataFrame) -> DataFrame:
    """Only where a webhook URL is non-empty: JSON of eventType, OrderId, Status."""
    payload = F.concat(F.lit('{"eventType":'), json_string("event_type"),
                       F.lit(',"OrderId":'), json_string("order_id"),
                       F.lit(',"Status":'), json_string("status"), F.lit("}"))
    return (events.where(F.col("webhook_url").isNotNull() & (F.col("webhook_url") != ""))
            .select("event_type", "order_id", F.col("webhook_url").alias("url"), payload.alias("payload")))


def low_stock_events(view: DataFrame, threshold: int = config.LOW_STOCK_THRESHOLD,
                     manager_email: str = WAREHOUSE_MANAGER_EMAIL) -> DataFrame:
    """InventoryLow events for products whose available stock is below ``threshold``."""
    return (view.where(F.col("available") < F.lit(threshold))
            .select(F.col("product_id"), F.col("product_name"),
                    F.col("available").cast("int").alias("remaining_stock"),
                    F.lit(manager_email).alias("warehouse_manager_email")))


def low_stock_notifications(events: DataFrame) -> DataFrame:
    """Alert e-mail per low-stock event."""
    vals = {"name": F.col("product_name"), "id": F.col("product_id"), "remaining": F.col("remaining_stock")}
    return events.select("product_id", F.col("warehouse_manager_email").alias("to"),
                         _fmt(config.LOW_STOCK_SUBJECT, vals).alias("subject"),
                         _fmt(config.LOW_STOCK_BODY, vals).alias("body"))


def dead_letter(records: DataFrame, ok_col: str = "ok", reason_col: str = "error") -> DataFrame:
    """Failed records keep key and value unchanged, gain the DLQ topic and a reason (q16)."""
    return (records.where(~F.col(ok_col))
            .select(F.lit(config.DEAD_LETTER_TOPIC).alias("topic"), "key", "value",
                    F.col(reason_col).alias("reason")))
