"""Hourly metrics over an unbounded event stream.

``withWatermark`` + ``groupBy(window)`` keeps running window totals in the
state store; ``outputMode("update")`` emits the changed windows each
micro-batch and ``foreachBatch`` upserts them by key (S5/S6), so stored
values are true window totals (q2), a late event within the watermark
updates its window (q3) and one beyond it is dropped by Spark and counted in
the query progress (``numRowsDroppedByWatermark``). The trigger interval /
``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` replace the reference's
flush interval and batch cap (A10: every micro-batch is partially
aggregated map-side before its shuffle).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import config
from ledgerline.functions.columns import avg_order_value, line_total
from ledgerline.sources.sinks import KeyedTable, ensure_tables


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """Streaming read of one table (a directory, or one file via a glob on its folder)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if os.path.isdir(path) or "://" in path:
        return r.parquet(path)
    return r.option("basePath", sf_dir).parquet(path[:-1] + "[" + path[-1] + "]")


def _hour_window(duration_seconds: int):
    """Event-time window on the watermarked column (so Spark evicts state and drops late rows).

    Its start is the UTC hour (P8); the end is start + duration, set after the aggregate.
    """
    return F.window("event_time", "3600 seconds").alias("w")


def _with_end(df: DataFrame, duration_seconds: int) -> DataFrame:
    start = F.col("w.start")
    return df.select(start.alias("window_start"),
                     (start + F.make_interval(secs=F.lit(duration_seconds))).alias("window_end"),
                     *[c for c in df.columns if c != "w"])


def hourly_metrics_stream(events: DataFrame, watermark: str,
                          statuses: list[str] | None = None,
                          duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    """Streaming A1 + A5: running window totals (event_time must be a timestamp)."""
    ev = events.withWatermark("event_time", watermark)
    if statuses is not None:
        ev = ev.where(F.col("status").isin(list(statuses)))
    agg = (ev.groupBy(_hour_window(duration_seconds))
           .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_revenue")))
    return _with_end(agg, duration_seconds).withColumn(
        "avg_order_value", avg_order_value("total_revenue", "order_count"))


def product_rows_stream(items: DataFrame, watermark: str,
                        duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    """Streaming A2–A4 over item rows."""
    it = items.withWatermark("event_time", watermark)
    agg = (it.groupBy(_hour_window(duration_seconds), "product_id")
           .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("total_quantity"),
                F.sum(line_total("unit_price", "quantity")).alias("total_revenue")))
    return _with_end(agg, duration_seconds)


def start_upsert(agg: DataFrame, table: KeyedTable, checkpoint: str, *, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Run ``agg`` in update mode into ``table`` (idempotent per batch id)."""
    w = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: table.upsert(df, batch_id)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark, over the query's reported batches."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def run_metrics_stream(spark: SparkSession, events: DataFrame, items: DataFrame, base: str,
                         watermark: str, available_now: bool = True) -> tuple[KeyedTable, KeyedTable]:
    """Both result tables from one event source: hourly metrics and top-product rows.

    Events that come later than ``watermark`` behind the newest one are dropped; a run over what is
    available raises if that happened, so a backlog whose files are not in time order never loses rows silently.
    """
    hourly, top = ensure_tables(spark, f"{base}/tables")
    q1 = start_upsert(hourly_metrics_stream(events, watermark), hourly, f"{base}/ckpt/hourly",
                      available_now=available_now, processing_time=f"{config.FLUSH_SECONDS} seconds")
    q2 = start_upsert(product_rows_stream(items, watermark), top, f"{base}/ckpt/top",
                      available_now=available_now, processing_time=f"{config.FLUSH_SECONDS} seconds")
    if available_now:
        q1.awaitTermination()
        q2.awaitTermination()
        if late := dropped_rows(q1) + dropped_rows(q2):
            raise RuntimeError(f"{late} rows came later than the watermark of {watermark}; take a longer one")
    return hourly, top
