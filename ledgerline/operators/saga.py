"""Order saga: correlation of its events and the derived state / commands.

Correlation is one union + ``groupBy(order_id)`` (a single shuffle with a
partial aggregate) instead of a chain of joins: any number of event kinds
costs one exchange, duplicates cannot multiply rows, and a hot order is
combined map-side. Events are correlated on ``order_id`` (q9).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import config

SAGA_EVENT_COLS = ["order_id", "event_type", "ts", "customer_id", "total_amount", "reason"]
CREATED, RESERVED, INV_FAILED = "OrderCreated", "InventoryReserved", "InventoryReservationFailed"
PAID, PAY_FAILED = "PaymentProcessed", "PaymentFailed"


def _tag(df: DataFrame, etype: str) -> DataFrame:
    cols = []
    for c in SAGA_EVENT_COLS:
        if c == "event_type":
            cols.append(F.lit(etype).alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("decimal(19,4)" if c == "total_amount" else
                                        "timestamp" if c == "ts" else "string").alias(c))
    return df.select(*cols)


def saga_events(created: DataFrame, reserved: DataFrame, failed: DataFrame,
                paid: DataFrame, pay_failed: DataFrame) -> DataFrame:
    """U1 of the five saga inputs into one tagged event frame."""
    frames = [_tag(created, CREATED), _tag(reserved, RESERVED), _tag(failed, INV_FAILED),
              _tag(paid, PAID), _tag(pay_failed, PAY_FAILED)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _first(etype: str, value: str) -> Column:
    """Value of the earliest event of a kind; equal times are broken by the value (deterministic)."""
    is_t = F.col("event_type") == etype
    return F.min_by(F.when(is_t, F.col(value)), F.when(is_t, F.struct(F.col("ts"), F.col(value))))


def saga_correlate(events: DataFrame) -> DataFrame:
    """One row per saga (order); sagas start with OrderCreated, other events alone are ignored."""
    et = F.col("event_type")
    agg = (events.groupBy("order_id")
           .agg(F.max((et == CREATED).cast("int")).alias("_started"),
                _first(CREATED, "ts").alias("created_at"),
                _first(CREATED, "customer_id").alias("customer_id"),
                _first(CREATED, "total_amount").alias("total_amount"),
                _first(RESERVED, "ts").alias("inventory_reserved_at"),
                _first(INV_FAILED, "ts").alias("inventory_failed_at"),
                _first(INV_FAILED, "reason").alias("inventory_reason"),
                _first(PAID, "ts").alias("paid_at"),
                _first(PAY_FAILED, "ts").alias("payment_failed_at"),
                _first(PAY_FAILED, "reason").alias("payment_reason")))
    return (agg.where(F.col("_started") == 1).drop("_started")
            .withColumn("inventory_id", F.concat(F.lit("inv-"), F.col("order_id")))
            .withColumn("payment_id", F.when(F.col("inventory_reserved_at").isNotNull(),
                                             F.concat(F.lit("pay-"), F.col("order_id")))))


def saga_status(saga: DataFrame) -> DataFrame:
    """awaiting_inventory → awaiting_payment → completed, or cancelled."""
    inv_failed = F.col("inventory_failed_at").isNotNull()
    reserved = F.col("inventory_reserved_at").isNotNull() & ~inv_failed
    paid = reserved & F.col("paid_at").isNotNull()
    pay_failed = reserved & ~paid & F.col("payment_failed_at").isNotNull()
    status = (F.when(inv_failed, "cancelled").when(paid, "completed").when(pay_failed, "cancelled")
              .when(reserved, "awaiting_payment").otherwise("awaiting_inventory"))
    reason = (F.when(inv_failed, F.concat(F.lit(config.INVENTORY_FAILED_PREFIX), F.col("inventory_reason")))
              .when(pay_failed, F.concat(F.lit(config.PAYMENT_FAILED_PREFIX), F.col("payment_reason"))))
    return saga.select("order_id", "customer_id", "total_amount", "inventory_id", "payment_id",
                       status.alias("saga_status"),
                       (inv_failed | paid | pay_failed).alias("ended"),
                       pay_failed.alias("stock_released"),
                       reason.alias("cancel_reason"))


def saga_commands(saga: DataFrame) -> DataFrame:
    """The commands the saga issued, one row each, in step order."""
    st = saga_status(saga)
    s, reason = F.col("saga_status"), F.col("cancel_reason")
    inv_failed = s.eqNullSafe("cancelled") & ~F.col("stock_released")
    reserved_path = F.col("payment_id").isNotNull()

    def cmd(cond, step, name, target, amount=None, why=None):
        return F.when(cond, F.struct(F.lit(step).alias("step"), F.lit(name).alias("command"),
                                     target.alias("target_id"),
                                     (amount if amount is not None else F.lit(None).cast("decimal(19,4)"))
                                     .alias("amount"),
                                     (why if why is not None else F.lit(None).cast("string")).alias("reason")))

    cmds = F.array_compact(F.array(
        cmd(F.lit(True), 1, "ReserveInventory", F.col("inventory_id")),
        cmd(reserved_path, 2, "ProcessPayment", F.col("payment_id"), F.col("total_amount")),
        cmd(s == "completed", 3, "ConfirmOrder", F.col("order_id")),
        cmd(inv_failed, 2, "CancelOrder", F.col("order_id"), why=reason),
        cmd(F.col("stock_released"), 3, "CancelInventoryReservation", F.col("inventory_id"), why=reason),
        cmd(F.col("stock_released"), 4, "CancelOrder", F.col("order_id"), why=reason),
    ))
    return st.select("order_id", F.explode(cmds).alias("c")).select("order_id", "c.*")
