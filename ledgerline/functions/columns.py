"""Scalar column expressions: P2, P6, P7, P8, A5 and type helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.schemas import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact money type, decimal(19,4)."""
    return _col(c).cast(MONEY)


def round_money(c, digits: int = 4) -> Column:
    """Presentation form of a money/ratio value: double rounded to ``digits``."""
    return F.round(_col(c).cast("double"), digits)


def to_ntz(c) -> Column:
    return _col(c).cast("timestamp_ntz")


def topic_to_status(topic) -> Column:
    """Analytics topic → status; an unknown topic maps to itself."""
    t = _col(topic)
    expr = None
    for name, status in config.TOPIC_STATUS.items():
        expr = (F.when(t == name, F.lit(status)) if expr is None
                else expr.when(t == name, F.lit(status)))
    return expr.otherwise(t)


def line_total(unit_price, quantity) -> Column:
    """Unit price × quantity, exact decimal."""
    return (_col(unit_price) * _col(quantity)).cast(MONEY)


def order_total(items) -> Column:
    """Σ line totals of an items array, starting at zero (empty → 0)."""
    return F.aggregate(
        F.coalesce(_col(items), F.array()),
        F.lit(0).cast(MONEY),
        lambda acc, it: (acc + it["unit_price"] * it["quantity"]).cast(MONEY),
    )


def assign_hour_window(ts, duration_seconds: int = config.WINDOW_SECONDS) -> tuple[Column, Column]:
    """start = UTC hour truncation whatever the duration; end = start + duration."""
    start = F.date_trunc("hour", _col(ts))
    end = start + F.make_interval(secs=F.lit(duration_seconds))
    return start, end


def avg_order_value(revenue, count) -> Column:
    """A5: revenue / count, 0 when count is 0 (double of the exact revenue, not rounded)."""
    r, n = _col(revenue), _col(count)
    return F.when(n > 0, r.cast("double") / n).otherwise(F.lit(0.0))
