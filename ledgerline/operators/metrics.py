"""Windowed order metrics and their range queries.

All aggregates are declarative ``groupBy().agg()`` so Spark runs a partial
(map-side) aggregate before the shuffle: a hot window or product is combined
inside every task and only one row per task and key crosses the network.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.functions.columns import assign_hour_window, avg_order_value, line_total, round_money
from ledgerline.schemas import MONEY


def parse_range(from_value: str | datetime, to_value: str | datetime) -> tuple[datetime, datetime]:
    """P10: ISO-8601 instants, strictly ``from < to``; errors name the bad bound."""
    def parse(v, name):
        if isinstance(v, datetime):
            d = v
        else:
            try:
                d = datetime.fromisoformat(str(v).replace("Z", "+00:00"))
            except ValueError as exc:
                raise ValueError(f"Invalid '{name}' instant: {v}") from exc
        if d.tzinfo is not None:
            d = d.astimezone(timezone.utc).replace(tzinfo=None)
        return d
    f, t = parse(from_value, "from"), parse(to_value, "to")
    if not f < t:
        raise ValueError(f"'from' must be before 'to': {from_value} >= {to_value}")
    return f, t


def window_scan_bounds(from_ts: datetime, to_ts: datetime,
                       duration_seconds: int = config.WINDOW_SECONDS) -> tuple[datetime, datetime]:
    """Event-time bounds [lo, hi) covering every event whose window is contained in [from, to].

    window_start = floor_hour(ts) >= from  ⇔  ts >= ceil_hour(from);
    window_end = floor_hour(ts) + duration <= to  ⇔  ts < floor_hour(to − duration) + 1 h.
    Applied to the raw event column these become parquet-pushable range filters
    (row groups outside the range are skipped); the containment filter stays
    as the exact predicate.
    """
    from datetime import timedelta
    hour = timedelta(hours=1)
    lo = from_ts.replace(minute=0, second=0, microsecond=0)
    if lo < from_ts:
        lo += hour
    hi = (to_ts - timedelta(seconds=duration_seconds)).replace(minute=0, second=0, microsecond=0) + hour
    return lo, max(lo, hi)


def with_window(df: DataFrame, ts: str = "event_time",
                duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    start, end = assign_hour_window(ts, duration_seconds)
    return df.withColumn("window_start", start).withColumn("window_end", end)


def hourly_metrics(events: DataFrame, statuses: list[str] | None = None,
                   duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    """A1 + A5: per window, event count and Σ amount over *every* event (q1).

    ``statuses=["created"]`` restricts to true order metrics. Output keeps
    exact totals (``total_revenue`` decimal) plus the rounded average.
    """
    ev = events.select("status", "total_amount", "event_time")
    if statuses is not None:
        ev = ev.where(F.col("status").isin(list(statuses)))
    return (with_window(ev, duration_seconds=duration_seconds)
            .groupBy("window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total_amount").alias("total_revenue"))
            .withColumn("avg_order_value", avg_order_value("total_revenue", "order_count")))


def product_window_rows(items: DataFrame, duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    """A2 + A3 + A4 in one aggregate: per window × product, Σ quantity and Σ revenue.

    ``items`` has one row per item (event_time, product_id, quantity,
    unit_price). Product rows are built before the shuffle so the partial
    aggregate combines them map-side.
    """
    return (with_window(items.select("event_time", "product_id", "quantity", "unit_price"),
                        duration_seconds=duration_seconds)
            .groupBy("window_start", "window_end", "product_id")
            .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("total_quantity"),
                 F.sum(line_total("unit_price", "quantity")).alias("total_revenue")))


def explode_items(events: DataFrame) -> DataFrame:
    """Item rows of normalised events (only events with items survive)."""
    return (events.where(F.size("items") > 0)
            .select("event_time", F.explode("items").alias("it"))
            .select("event_time", "it.product_id", "it.quantity", "it.unit_price"))


def contained(df: DataFrame, from_ts, to_ts) -> DataFrame:
    """Windows with start >= from AND end <= to (partial windows excluded)."""
    return df.where((F.col("window_start") >= F.lit(from_ts)) & (F.col("window_end") <= F.lit(to_ts)))


def hourly_series(metrics: DataFrame, from_ts, to_ts) -> DataFrame:
    """Contained windows ordered by start."""
    return contained(metrics, from_ts, to_ts).orderBy("window_start")


def revenue_summary(metrics: DataFrame, from_ts, to_ts) -> DataFrame:
    """Σ revenue, Σ count and weighted average; one row of zeros when empty."""
    agg = (contained(metrics, from_ts, to_ts)
           .agg(F.coalesce(F.sum("total_revenue"), F.lit(0).cast(MONEY)).alias("total_revenue"),
                F.coalesce(F.sum("order_count"), F.lit(0)).cast("long").alias("order_count")))
    return agg.select(F.lit(from_ts).cast("timestamp").alias("range_from"),
                      F.lit(to_ts).cast("timestamp").alias("range_to"),
                      round_money("total_revenue").alias("total_revenue"),
                      "order_count",
                      avg_order_value("total_revenue", "order_count").alias("avg_order_value"))


def top_products(rows: DataFrame, from_ts, to_ts, limit: int = config.TOP_PRODUCTS_LIMIT) -> DataFrame:
    """Contained window × product rows by revenue desc, first ``limit``.

    Not re-aggregated across windows (a product may repeat). Ties broken by
    product and window so the result is deterministic (q18). Plans as
    ``TakeOrderedAndProject``: each task keeps its local top ``limit``.
    """
    return (contained(rows, from_ts, to_ts)
            .orderBy(F.col("total_revenue").desc(), F.col("product_id").asc(), F.col("window_start").asc())
            .limit(limit))


def batch_partial_metrics(events: DataFrame, batch_col: str,
                          duration_seconds: int = config.WINDOW_SECONDS) -> DataFrame:
    """A10: per-chunk partial window totals (the chunked accumulator), then merged.

    ``batch_col`` names the chunk (e.g. a micro-batch id). Returns one row per
    chunk × window; summing them over chunks gives the A1 totals, which is the
    invariant the streaming sink relies on.
    """
    return (with_window(events.select(batch_col, "total_amount", "event_time"),
                        duration_seconds=duration_seconds)
            .groupBy(batch_col, "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total_amount").alias("total_revenue")))
