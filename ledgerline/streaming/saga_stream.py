"""K12 as a stream: saga state maintained from the stream of saga events.

Correlation keeps, per order and event kind, the first event (``min_by`` on
its time) — associative, so each micro-batch is correlated on its own into
partial rows that merge exactly with the same rule. Partials are written per
``batch_id`` (idempotent); the saga state is ``saga_status`` over the merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import saga as S

BATCH_COL = "batch_id"
_KINDS = {S.CREATED: "created", S.RESERVED: "reserved", S.INV_FAILED: "inv_failed",
          S.PAID: "paid", S.PAY_FAILED: "pay_failed"}
_VALUES = {S.CREATED: ["customer_id", "total_amount"], S.INV_FAILED: ["reason"], S.PAY_FAILED: ["reason"]}


def partial_correlate(events: DataFrame) -> DataFrame:
    """Per order and kind: the time of its first event and that event's values."""
    aggs = []
    for kind, short in _KINDS.items():
        is_k = F.col("event_type") == kind
        aggs.append(F.min(F.when(is_k, F.col("ts"))).alias(f"{short}_ts"))
        for v in _VALUES.get(kind, []):
            aggs.append(F.min_by(F.when(is_k, F.col(v)), F.when(is_k, F.struct(F.col("ts"), F.col(v))))
                        .alias(f"{short}_{v}"))
    return events.groupBy("order_id").agg(*aggs)


def merge_correlated(partials: DataFrame) -> DataFrame:
    """Merge partials into the J2 shape (sagas start with OrderCreated)."""
    aggs = []
    for kind, short in _KINDS.items():
        aggs.append(F.min(f"{short}_ts").alias(f"{short}_ts"))
        for v in _VALUES.get(kind, []):
            aggs.append(F.min_by(f"{short}_{v}", F.struct(f"{short}_ts", f"{short}_{v}")).alias(f"{short}_{v}"))
    m = partials.groupBy("order_id").agg(*aggs).where(F.col("created_ts").isNotNull())
    return m.select(
        "order_id", F.col("created_ts").alias("created_at"), F.col("created_customer_id").alias("customer_id"),
        F.col("created_total_amount").alias("total_amount"),
        F.col("reserved_ts").alias("inventory_reserved_at"), F.col("inv_failed_ts").alias("inventory_failed_at"),
        F.col("inv_failed_reason").alias("inventory_reason"), F.col("paid_ts").alias("paid_at"),
        F.col("pay_failed_ts").alias("payment_failed_at"), F.col("pay_failed_reason").alias("payment_reason"),
        F.concat(F.lit("inv-"), F.col("order_id")).alias("inventory_id"),
        F.when(F.col("reserved_ts").isNotNull(), F.concat(F.lit("pay-"), F.col("order_id"))).alias("payment_id"))


def start_saga_stream(events_stream: DataFrame, path: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        (partial_correlate(batch).withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(path))
    w = events_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_saga_status(spark: SparkSession, path: str) -> DataFrame:
    return S.saga_status(merge_correlated(spark.read.parquet(path).drop(BATCH_COL)))
