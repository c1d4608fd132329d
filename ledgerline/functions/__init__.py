"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from ledgerline.functions.columns import (  # noqa: F401
    assign_hour_window, avg_order_value, line_total, money, order_total,
    round_money, topic_to_status, to_ntz,
)
