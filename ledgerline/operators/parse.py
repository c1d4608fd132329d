"""Decoding of topic records.

Every JSON payload is decoded with a declared schema plus a
``_corrupt_record`` column (PERMISSIVE mode): a malformed record never fails
the job, it is classified and can be quarantined or dead-lettered (q14, q16).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import order_total, topic_to_status
from ledgerline.schemas import (JSON_ORDER_CREATED, JSON_ORDER_STATUS, MONEY, ORDER_ITEM)

CORRUPT = "_corrupt_record"
_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def _missing(parsed: Column, fields: list[str]) -> Column:
    """Name of the first required field that is null (``missing_field:<name>``)."""
    expr = None
    for f in fields:
        cond = parsed[f].isNull()
        val = F.lit(f"missing_field:{f}")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def _iso_ts(c: Column) -> Column:
    return F.try_to_timestamp(c)


def _barrier(df: DataFrame) -> DataFrame:
    """Pin the decoded columns: a filter on them cannot be pushed below a generator,
    so a later ``where(ok)`` does not evaluate ``from_json`` a second time."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def parse_order_event(records: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """P1 + P2: one normalised row per record, with ``ok`` and ``error``.

    ``order.created`` decodes with items and createdAt; any other topic as a
    status event with empty items and updatedAt; status comes from the topic.
    """
    created = F.from_json(F.col(value), _with_corrupt(JSON_ORDER_CREATED), _OPTS)
    status_ev = F.from_json(F.col(value), _with_corrupt(JSON_ORDER_STATUS), _OPTS)
    is_created = F.col(topic) == "order.created"
    rec = records.withColumn("_c", F.when(is_created, created)).withColumn("_s", F.when(~is_created, status_ev))
    c, s = F.col("_c"), F.col("_s")
    items = F.transform(c["items"], lambda it: F.struct(
        it["productId"].alias("product_id"), it["productName"].alias("product_name"),
        it["quantity"].alias("quantity"), it["unitPrice"].alias("unit_price")))
    bad_item = F.exists(F.coalesce(c["items"], F.array()), lambda it: it["productId"].isNull()
                        | it["productName"].isNull() | it["quantity"].isNull() | it["unitPrice"].isNull())
    c_time, s_time = _iso_ts(c["createdAt"]), _iso_ts(s["updatedAt"])
    c_err = (F.when(F.col(value).isNull(), F.lit("malformed_json"))
             .when(c[CORRUPT].isNotNull(), F.lit("malformed_json"))
             .otherwise(F.coalesce(_missing(c, ["orderId", "customerId", "items", "totalAmount", "createdAt"]),
                                   F.when(bad_item, F.lit("missing_field:items")),
                                   F.when(c_time.isNull(), F.lit("bad_timestamp")))))
    s_err = (F.when(F.col(value).isNull(), F.lit("malformed_json"))
             .when(s[CORRUPT].isNotNull(), F.lit("malformed_json"))
             .otherwise(F.coalesce(_missing(s, ["orderId", "customerId", "status", "totalAmount", "updatedAt"]),
                                   F.when(s_time.isNull(), F.lit("bad_timestamp")))))
    err = F.when(is_created, c_err).otherwise(s_err)
    empty = F.array().cast(T.ArrayType(ORDER_ITEM))
    rec = rec.withColumn("_err", err)
    err = F.col("_err")
    out = rec.select(
        *[c for c in records.columns],
        err.isNull().alias("ok"), err.alias("error"),
        F.when(is_created, c["orderId"]).otherwise(s["orderId"]).alias("order_id"),
        F.when(is_created, c["customerId"]).otherwise(s["customerId"]).alias("customer_id"),
        F.when(is_created, c["totalAmount"]).otherwise(s["totalAmount"]).cast(MONEY).alias("total_amount"),
        F.when(is_created, items).otherwise(empty).alias("items"),
        topic_to_status(F.col(topic)).alias("status"),
        F.when(is_created, c_time).otherwise(s_time).alias("event_time"),
    ).drop("_c", "_s")
    return _barrier(out)


def observe_decoding(parsed: DataFrame, observation) -> DataFrame:
    """Attach decode counters (records, malformed, missing field, bad timestamp) to the plan.

    ``observation`` is a ``pyspark.sql.Observation``; its ``get`` holds the
    counts once an action on the returned frame has run — no extra job.
    """
    err = F.col("error")
    return parsed.observe(
        observation,
        F.count(F.lit(1)).alias("records"),
        F.sum((err == "malformed_json").cast("long")).alias("malformed_json"),
        F.sum(err.startswith("missing_field").cast("long")).alias("missing_field"),
        F.sum((err == "bad_timestamp").cast("long")).alias("bad_timestamp"))


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid normalised events, quarantined raw records with their error)."""
    valid = parsed.where("ok").select("order_id", "customer_id", "total_amount", "items", "status", "event_time")
    bad = parsed.where(~F.col("ok")).select(
        *[c for c in ("topic", "key", "value", "partition", "offset", "timestamp") if c in parsed.columns], "error")
    return valid, bad


def dedupe_records(records: DataFrame, keys: tuple[str, ...] = ("topic", "partition", "offset"),
                   watermark: str | None = None, ts: str = "timestamp") -> DataFrame:
    """q12: drop redelivered records (same topic, partition, offset) before they reach a fold.

    On a stream a ``watermark`` bounds the de-duplication state and is required, as records that
    come later than it are lost; where none may be (stock), drop them by the ids that earlier
    batches have written (``streaming.reservations.start_inventory_stream``).
    """
    if records.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs an explicit watermark: records later than it are dropped")
        return records.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))
    return records.dropDuplicates(list(keys))


def union_topics(*dfs: DataFrame) -> DataFrame:
    """One frame over several topics (missing columns become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --------------------------------------------------------------------------- envelopes
_KAFKA_ITEM = T.StructType([T.StructField("productId", T.StringType()),
                            T.StructField("quantity", T.IntegerType())])
_ENVELOPE = T.StructType([T.StructField("eventType", T.StringType()),
                          T.StructField("payload", T.StringType())])
_PAYLOAD = T.StructType([T.StructField("orderId", T.StringType()),
                         T.StructField("customerId", T.StringType()),
                         T.StructField("items", T.ArrayType(_KAFKA_ITEM)),
                         T.StructField("totalAmount", MONEY),
                         T.StructField("shippingAddress", T.StringType()),
                         T.StructField("createdAt", T.StringType()),
                         T.StructField("reason", T.StringType())])
PAYLOAD_REQUIRED = {
    "ORDER_CREATED": ["orderId", "customerId", "items", "totalAmount", "shippingAddress", "createdAt"],
    "ORDER_CANCELLED": ["orderId", "reason"],
    "ORDER_CONFIRMED": ["orderId", "items"],
}
ACTION_OF_TYPE = {"ORDER_CREATED": "reserve", "ORDER_CANCELLED": "release", "ORDER_CONFIRMED": "confirm"}


def parse_envelope(records: DataFrame, value: str = "value") -> DataFrame:
    """``eventType`` (missing → UNKNOWN) and the payload JSON string decoded again per type."""
    env = F.from_json(F.col(value), _with_corrupt(_ENVELOPE), _OPTS)
    rec = records.withColumn("_e", env)
    et = F.coalesce(F.col("_e.eventType"), F.lit("UNKNOWN"))
    pay = F.from_json(F.col("_e.payload"), _with_corrupt(_PAYLOAD), _OPTS)
    rec = rec.withColumn("event_type", et).withColumn("_p", pay)
    p = F.col("_p")
    missing = None
    for etype, fields in PAYLOAD_REQUIRED.items():
        m = F.when(F.col("event_type") == etype, _missing(p, fields))
        missing = m if missing is None else F.coalesce(missing, m)
    handled = F.col("event_type").isin(list(PAYLOAD_REQUIRED))
    err = (F.when(F.col(value).isNull() | F.col("_e." + CORRUPT).isNotNull(), F.lit("malformed_json"))
           .when(handled & (F.col("_e.payload").isNull() | p[CORRUPT].isNotNull()), F.lit("malformed_payload"))
           .when(handled, missing))
    items = F.transform(F.coalesce(p["items"], F.array().cast(T.ArrayType(_KAFKA_ITEM))),
                        lambda it: F.struct(it["productId"].alias("product_id"), it["quantity"].alias("quantity")))
    rec = rec.withColumn("_err", err)
    out = rec.select(*records.columns, "event_type", F.col("_err").isNull().alias("ok"), F.col("_err").alias("error"),
                     p["orderId"].alias("order_id"), items.alias("items"), p["reason"].alias("reason"))
    return _barrier(out)


def route_by_event_type(envelopes: DataFrame) -> dict[str, DataFrame]:
    """P5 (+K9 warnings): CREATED → reserve, CANCELLED → release, CONFIRMED → confirm.

    Returns ``commands`` (one stock command per item), ``empty`` (handled
    events whose item list is empty: nothing done, warning — q20),
    ``ignored`` (other types) and ``bad`` (records that did not decode, for the
    dead letters). Every record is in exactly one of empty, ignored and bad, or has commands.
    """
    et = F.col("event_type")
    action = None
    for etype, act in ACTION_OF_TYPE.items():
        action = F.when(et == etype, F.lit(act)) if action is None else action.when(et == etype, F.lit(act))
    ok = envelopes.where("ok").withColumn("kind", action)
    handled = ok.where(F.col("kind").isNotNull())
    carry = [c for c in ("offset", "timestamp") if c in envelopes.columns]
    commands = (handled.select("order_id", "kind", F.posexplode("items").alias("item_pos", "it"), *carry)
                .select("it.product_id", "kind", "order_id", "it.quantity", "item_pos", *carry))
    return {"commands": commands,
            "empty": handled.where(F.size("items") == 0),
            "ignored": ok.where(F.col("kind").isNull()),
            "bad": envelopes.where(~F.col("ok"))}


def recover_items(events: DataFrame, created_items: DataFrame, found: str | None = None) -> DataFrame:
    """q20: cancel/confirm events without items take the items of their Created event; ``found``: a column that says whether there is one."""
    it = created_items.select("order_id", F.col("items").alias("_created_items"), *([F.lit(True).alias(found)] if found else []))
    out = (events.join(it, "order_id", "left")
           .withColumn("items", F.when(F.size("items") > 0, F.col("items"))
                       .otherwise(F.coalesce("_created_items", F.col("items"))))
           .drop("_created_items"))
    return out.withColumn(found, F.coalesce(found, F.lit(False))) if found else out


# --------------------------------------------------------------------------- validation
def validate_orders(created: DataFrame) -> DataFrame:
    """Non-blank customer/address/product id/name, items non-empty, quantity ≥ 1, price > 0.

    Adds ``valid`` and ``reasons`` (array of rule names that failed).
    """
    items = F.coalesce(F.col("items"), F.array().cast(T.ArrayType(ORDER_ITEM)))

    def blank(c: Column) -> Column:
        return c.isNull() | (F.trim(c) == "")

    rules = [
        ("customer_id_blank", blank(F.col("customer_id"))),
        ("shipping_address_blank", blank(F.col("shipping_address"))),
        ("items_empty", F.size(items) == 0),
        ("product_id_blank", F.exists(items, lambda i: blank(i["product_id"]))),
        ("product_name_blank", F.exists(items, lambda i: blank(i["product_name"]))),
        ("quantity_below_1", F.exists(items, lambda i: i["quantity"].isNull() | (i["quantity"] < 1))),
        ("unit_price_not_positive", F.exists(items, lambda i: i["unit_price"].isNull() | (i["unit_price"] <= 0))),
    ]
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return (created.withColumn("reasons", reasons)
            .withColumn("valid", F.size("reasons") == 0)
            .withColumn("total_amount", order_total(items)))


def validate_order_lines(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """P11 over a line table: the same rules as ``validate_orders`` as per-order aggregates.

    ``headers``: order_id, customer_id, shipping_address; ``lines``: order_id,
    product_id, product_name, quantity, unit_price. Every rule is a
    ``bool_or`` with a partial aggregate, so no order's items are ever
    gathered into one row (an order with a third of all lines is combined
    map-side like any other).
    """
    def blank(c: Column) -> Column:
        return c.isNull() | (F.trim(c) == "")

    per_order = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.bool_or(blank(F.col("product_id"))).alias("product_id_blank"),
        F.bool_or(blank(F.col("product_name"))).alias("product_name_blank"),
        F.bool_or(F.col("quantity").isNull() | (F.col("quantity") < 1)).alias("quantity_below_1"),
        F.bool_or(F.col("unit_price").isNull() | (F.col("unit_price") <= 0)).alias("unit_price_not_positive"),
        F.sum((F.col("unit_price") * F.col("quantity")).cast(MONEY)).cast(MONEY).alias("_total"))
    j = headers.join(per_order, "order_id", "left")
    rules = [
        ("customer_id_blank", blank(F.col("customer_id"))),
        ("shipping_address_blank", blank(F.col("shipping_address"))),
        ("items_empty", F.col("_n").isNull()),
        ("product_id_blank", F.coalesce(F.col("product_id_blank"), F.lit(False))),
        ("product_name_blank", F.coalesce(F.col("product_name_blank"), F.lit(False))),
        ("quantity_below_1", F.coalesce(F.col("quantity_below_1"), F.lit(False))),
        ("unit_price_not_positive", F.coalesce(F.col("unit_price_not_positive"), F.lit(False))),
    ]
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return j.select(*headers.columns, reasons.alias("reasons"), (F.size(reasons) == 0).alias("valid"),
                    F.coalesce(F.col("_total"), F.lit(0).cast(MONEY)).alias("total_amount"))


def event_type_counts(df: DataFrame, col: str = "error") -> DataFrame:
    """Counts per error class (the observable replacement for 'logged and dropped')."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("records"))
