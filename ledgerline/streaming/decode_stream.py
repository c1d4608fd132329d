"""Stateless streams: topic decoding with a dead-letter side output, and notifications.

``foreachBatch`` decodes a micro-batch once (written to the batch's own
folder), then writes the valid events and the dead letters (S9) as two
sinks; both writes overwrite the batch's partition, so a retried batch is
idempotent. Notification records (N5 → N1) likewise go to notifications,
dead letters and a side output for the other routes, from one decode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import notify as N
from ledgerline.operators import parse as P

_NOTIFY_JSON = ("struct<OrderId:string,CustomerEmail:string,Status:string,TrackingNumber:string,"
                "CancellationReason:string,WebhookUrl:string,_corrupt_record:string>")
# the field an order notification cannot do without (one without a recipient is still sent on)
_NOTIFY_REQUIRED = ("OrderId",)


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def start_decode_stream(spark: SparkSession, records: DataFrame, base: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """P1/P3/S9 on a record stream: ``base/events`` (valid) and ``base/dead_letters``."""
    def batch(df: DataFrame, batch_id: int) -> None:
        staged = f"{base}/decoded/batch_id={int(batch_id)}"
        P.parse_order_event(df).write.mode("overwrite").parquet(staged)
        parsed = spark.read.parquet(staged)
        valid, _ = P.quarantine(parsed)
        _write(valid, f"{base}/events", batch_id)
        _write(N.dead_letter(parsed), f"{base}/dead_letters", batch_id)
    w = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def decode_notifications(records: DataFrame) -> DataFrame:
    """Notification records (key = event type) with their ``route`` (N5); those of the order route decoded, with
    ``ok`` and ``error`` (malformed JSON or a required field that is missing)."""
    routed = N.with_route(records.withColumn("event_type", F.col("key")))
    is_order = F.col("route") == "order"
    j = F.from_json("value", _NOTIFY_JSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    routed = routed.withColumn("_j", F.when(is_order, j))
    error = F.when(F.col("value").isNull() | F.col("_j._corrupt_record").isNotNull(), F.lit("malformed_json"))
    for field in _NOTIFY_REQUIRED:
        error = error.when(F.col(f"_j.{field}").isNull(), F.lit(f"missing_field:{field}"))
    error = F.when(is_order, error)
    return routed.select("key", "value", "event_type", "route", F.col("_j.OrderId").alias("order_id"),
                         F.col("_j.CustomerEmail").alias("customer_email"), F.col("_j.Status").alias("status"),
                         F.col("_j.TrackingNumber").alias("tracking_number"),
                         F.col("_j.CancellationReason").alias("cancellation_reason"),
                         F.col("_j.WebhookUrl").alias("webhook_url"), error.isNull().alias("ok"), error.alias("error"))


NOTIFICATION_SINKS = ("notifications", "dead_letters", "others")


def write_notifications(spark: SparkSession, records: DataFrame, base: str, batch_id: int = 0) -> None:
    """One decode of notification records, three sinks below ``base``: ``notifications`` (N1), ``dead_letters`` (S9) and
    ``others`` (records of the other routes, as they are). Every record is in exactly one of them."""
    staged = f"{base}/decoded/batch_id={int(batch_id)}"
    decode_notifications(records).write.mode("overwrite").parquet(staged)
    decoded = spark.read.parquet(staged)
    order = F.col("route") == "order"
    _write(N.order_notifications(decoded.where(order & F.col("ok"))), f"{base}/notifications", batch_id)
    _write(N.dead_letter(decoded.where(order)), f"{base}/dead_letters", batch_id)
    _write(decoded.where(~order).select("key", "value", "route"), f"{base}/others", batch_id)


def start_notification_stream(spark: SparkSession, records: DataFrame, base: str, checkpoint: str,
                              available_now: bool = True) -> StreamingQuery:
    """N5 → N1 with S9 on a stream of notification records."""
    w = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: write_notifications(spark, df, base, batch_id))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


_SINK_DDL = {"notifications": "event_type string, order_id string, to string, subject string, body string",
             "dead_letters": "topic string, key string, value string, reason string", "others": "key string, value string, route string"}


def read_notifications(spark: SparkSession, base: str, sink: str = "notifications") -> DataFrame:
    return spark.read.schema(_SINK_DDL[sink] + ", batch_id long").parquet(f"{base}/{sink}").drop("batch_id")
