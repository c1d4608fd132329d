"""Rate-window audits (K15, K16): which windows exceed a permit limit.

Fixed windows are a tumbling ``window``; the sliding limiter's
``segments`` become the slide (window / segments). Both are aggregates
with map-side combine; a hot key only adds to its partial counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import config


def _event_time(events: DataFrame, ts: str):
    """The time column as a timestamp (kept as is when it already is one, so a
    watermark on it still applies)."""
    if isinstance(events.schema[ts].dataType, T.TimestampType):
        return F.col(ts)
    return F.col(ts).cast("timestamp")


def fixed_window_breaches(events: DataFrame, limit: int, seconds: int = config.RATE_WINDOW_SECONDS,
                          key: str | None = None, ts: str = "ts") -> DataFrame:
    """Per (fixed window[, key]) request count > ``limit``, with the excess."""
    w = F.window(_event_time(events, ts), f"{seconds} seconds")
    keys = [w.alias("w")] + ([F.col(key)] if key else [])
    counted = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("request_count"))
    return (counted.where(F.col("request_count") > limit)
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *([F.col(key)] if key else []), "request_count",
                    (F.col("request_count") - F.lit(limit)).alias("excess")))


def sliding_window_breaches(events: DataFrame, limit: int, seconds: int = config.RATE_WINDOW_SECONDS,
                            segments: int = config.RATE_SEGMENTS, ts: str = "ts") -> DataFrame:
    """Windows of ``seconds`` sliding by ``seconds / segments`` with count > ``limit``."""
    if seconds % segments:
        raise ValueError("seconds must be a multiple of segments")
    step = seconds // segments
    # every event is counted once, in its segment; only the segment counts are dealt to the
    # windows that hold them
    w = F.window(_event_time(events, ts), f"{step} seconds")
    segment = events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    starts = F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), lambda k: F.col("w.start") - F.make_interval(secs=k * F.lit(step)))
    counted = (segment.select(F.explode(starts).alias("window_start"), "n")
               .groupBy("window_start").agg(F.sum("n").alias("request_count")))
    return (counted.where(F.col("request_count") > limit)
            .select("window_start", (F.col("window_start") + F.make_interval(secs=F.lit(seconds))).alias("window_end"),
                    "request_count", (F.col("request_count") - F.lit(limit)).alias("excess")))


def fixed_window_counts_stream(events: DataFrame, seconds: int = config.RATE_WINDOW_SECONDS, key: str | None = None,
                               ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """K15 on a stream: running request counts of every window, for update mode into a keyed table.

    Without a watermark no event is ever too late; with one, Spark drops the state (and later
    events) of windows that end before it.
    """
    ev = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark is not None:
        ev = ev.withWatermark("_ts", watermark)
    keys = [F.window("_ts", f"{seconds} seconds").alias("w")] + ([F.col(key)] if key else [])
    return (ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("request_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *([F.col(key)] if key else []), "request_count"))


def breaches(counts: DataFrame, limit: int) -> DataFrame:
    """Windows of a count table above ``limit``, with the excess."""
    return counts.where(F.col("request_count") > limit).withColumn("excess", F.col("request_count") - F.lit(limit))
