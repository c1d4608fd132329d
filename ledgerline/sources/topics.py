"""Topic readers (S1–S3) and record builders (S10, the analytics topic layout).

A record is (topic, key, value, partition, offset, timestamp) whether it
comes from Kafka or from files carrying the same columns; files are used
where no Kafka connector is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.schemas import TOPIC_RECORD

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _kafka(spark: SparkSession, topics: list[str], bootstrap: str, starting: str,
           max_per_trigger: int | None, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if stream and max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
    return r.load().selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                               "partition", "offset", "timestamp")


def read_topics(spark: SparkSession, topics: list[str], path: str | None = None, *, fmt: str = "parquet",
                bootstrap: str | None = None, starting: str = "earliest", stream: bool = False,
                max_per_trigger: int | None = None) -> DataFrame:
    """Records of ``topics`` from Kafka (``bootstrap``) or from record files at ``path``."""
    if bootstrap:
        return _kafka(spark, topics, bootstrap, starting, max_per_trigger, stream)
    if path is None:
        raise ValueError("either bootstrap servers or a record path is required")
    if stream:
        r = spark.readStream.schema(TOPIC_RECORD).format(fmt)
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.schema(TOPIC_RECORD).format(fmt).load(path)
    return df.where(F.col("topic").isin(list(topics)))


def read_order_topics(spark: SparkSession, path: str | None = None,
                      topics: list[str] | None = None, **kw) -> DataFrame:
    """The analytics consumer's subscription (per-status topics by default, q6)."""
    return read_topics(spark, topics or config.ANALYTICS_TOPICS, path, **kw)


def read_order_envelopes(spark: SparkSession, path: str | None = None, **kw) -> DataFrame:
    """The inventory consumer's ``order-events`` topic."""
    return read_topics(spark, [config.ORDER_EVENTS_TOPIC], path, **kw)


def read_notification_events(spark: SparkSession, path: str | None = None, **kw) -> DataFrame:
    """S3: ``order-events`` + ``inventory-events``; the record key is the event type."""
    df = read_topics(spark, [config.ORDER_EVENTS_TOPIC, config.INVENTORY_EVENTS_TOPIC], path, **kw)
    return df.withColumn("event_type", F.col("key"))


# --------------------------------------------------------------------------- record builders
def order_created_json(order_id, customer_id, items, total, ts) -> F.Column:
    """Analytics-layout OrderCreated value (camelCase, ISO instant)."""
    its = F.transform(items, lambda it: F.struct(
        it["product_id"].alias("productId"), it["product_name"].alias("productName"),
        it["quantity"].alias("quantity"), it["unit_price"].alias("unitPrice")))
    return F.to_json(F.struct(order_id.alias("orderId"), customer_id.alias("customerId"), its.alias("items"),
                              total.alias("totalAmount"), F.date_format(ts, ISO_MICROS).alias("createdAt")))


def order_status_json(order_id, customer_id, status, total, ts) -> F.Column:
    return F.to_json(F.struct(order_id.alias("orderId"), customer_id.alias("customerId"), status.alias("status"),
                              total.alias("totalAmount"), F.date_format(ts, ISO_MICROS).alias("updatedAt")))


ENVELOPE_TYPE_OF_EVENT = {
    "OrderCreated": "ORDER_CREATED",
    "OrderConfirmed": "ORDER_CONFIRMED",
    "OrderShipped": "ORDER_SHIPPED",
    "OrderDelivered": "ORDER_DELIVERED",
    "OrderCancelled": "ORDER_CANCELLED",
}


def publish_order_events(journal: DataFrame, created: DataFrame | None = None) -> DataFrame:
    """Domain events as ``order-events`` envelope records keyed by order id.

    The payload is a JSON string inside the JSON envelope. Created carries its
    items; Cancelled and Confirmed carry none, as the domain events have none
    (q20: ``parse.recover_items`` restores them). ``created`` may be left out where the
    journal's events carry ``items`` and ``shipping_address`` of their order themselves.
    """
    j = journal if created is None else journal.join(created.select("order_id", "items", "shipping_address"), "order_id", "left")
    et = None
    for ev, name in ENVELOPE_TYPE_OF_EVENT.items():
        c = F.col("event_type") == ev
        et = F.when(c, F.lit(name)) if et is None else et.when(c, F.lit(name))
    kitems = F.transform(F.coalesce("items", F.array()), lambda i: F.struct(
        i["product_id"].alias("productId"), i["quantity"].alias("quantity")))
    empty = F.array().cast("array<struct<productId:string,quantity:int>>")
    is_created = F.col("event_type") == "OrderCreated"
    payload = F.when(is_created, F.to_json(F.struct(
        F.col("order_id").alias("orderId"), F.col("customer_id").alias("customerId"), kitems.alias("items"),
        F.col("total_amount").alias("totalAmount"), F.col("shipping_address").alias("shippingAddress"),
        F.date_format("ts", ISO_MICROS).alias("createdAt")))) \
        .when(F.col("event_type") == "OrderCancelled", F.to_json(F.struct(
            F.col("order_id").alias("orderId"), F.col("reason").alias("reason"), empty.alias("items")))) \
        .otherwise(F.to_json(F.struct(F.col("order_id").alias("orderId"), empty.alias("items"))))
    value = F.to_json(F.struct(et.alias("eventType"), payload.alias("payload")))
    return j.select(F.lit(config.ORDER_EVENTS_TOPIC).alias("topic"), F.col("order_id").alias("key"),
                    value.alias("value"), F.lit(0).alias("partition"),
                    (F.col("order_key") * F.lit(8) + F.col("seq")).cast("long").alias("offset"),
                    F.col("ts").alias("timestamp"))
