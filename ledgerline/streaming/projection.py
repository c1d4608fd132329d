"""K11 as a stream: the order read model maintained from the event stream.

Replay is associative: every field is "the value of the highest-sequence
event of some kind", so a micro-batch can be replayed on its own into a
*partial* state per order (value + the sequence it came from), and partials
merge with the same ``max_by``. Each micro-batch writes its partials into
its own ``batch_id`` partition (idempotent overwrite); the read model is the
merge of all partials. A late or duplicated event can only win if its
sequence is higher — the sequence guard of q19 — and the cost per batch is
the batch, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.orders import event_status

BATCH_COL = "batch_id"
_FIELDS = {  # field → (event kind that sets it or None for any event, source column)
    "status": (None, "_status"),
    "updated_at": (None, "ts"),
    "customer_id": ("OrderCreated", "customer_id"),
    "total_amount": ("OrderCreated", "total_amount"),
    "created_at": ("OrderCreated", "ts"),
    "tracking_number": ("OrderShipped", "tracking_number"),
    "carrier": ("OrderShipped", "carrier"),
}
_SEQ_OF = {None: "last_seq", "OrderCreated": "created_seq", "OrderShipped": "shipped_seq"}


def partial_replay(events: DataFrame) -> DataFrame:
    """Per order: each field with the sequence number it was taken from."""
    ev = events.withColumn("_status", event_status())
    aggs = []
    for kind, seq_name in _SEQ_OF.items():
        cond = F.lit(True) if kind is None else (F.col("event_type") == kind)
        aggs.append(F.max(F.when(cond, F.col("seq"))).alias(seq_name))
    for name, (kind, src) in _FIELDS.items():
        cond = F.lit(True) if kind is None else (F.col("event_type") == kind)
        aggs.append(F.max_by(F.when(cond, F.col(src)), F.when(cond, F.col("seq"))).alias(name))
    return ev.groupBy("order_id").agg(*aggs)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Merge partial states (any number, any order) into the read model."""
    aggs = [F.max(c).alias(c) for c in _SEQ_OF.values()]
    for name, (kind, _) in _FIELDS.items():
        aggs.append(F.max_by(name, _SEQ_OF[kind]).alias(name))
    merged = partials.groupBy("order_id").agg(*aggs)
    return (merged.where(F.col("created_seq").isNotNull())      # orphans stay out (J5)
            .select("order_id", "status", "last_seq", "updated_at", "customer_id", "total_amount",
                    "created_at", "tracking_number", "carrier"))


def write_partials(batch: DataFrame, batch_id: int, path: str) -> None:
    (partial_replay(batch).withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_COL).parquet(path))


def start_order_summary_stream(journal_stream: DataFrame, path: str, checkpoint: str,
                               available_now: bool = True) -> StreamingQuery:
    w = (journal_stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: write_partials(df, batch_id, path)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_order_summary(spark: SparkSession, path: str) -> DataFrame:
    return merge_partials(spark.read.parquet(path).drop(BATCH_COL))
