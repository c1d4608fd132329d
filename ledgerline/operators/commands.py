"""Order command handling as a sequential fold per order.

Confirm needs PENDING, ship CONFIRMED, deliver SHIPPED; cancel is rejected
from SHIPPED/DELIVERED and a silent no-op from CANCELLED; a rejected command
leaves the state unchanged. Commands for an order that was never created are
rejected. Runs on ``keyed_fold`` (bounded memory per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.operators.fold import KeyedFold, keyed_fold
from ledgerline.schemas import ORDER_COMMAND_RESULT_DDL

TRANSITIONS = config.COMMAND_TRANSITIONS
# which command re-issues each journal event (our replay of a journal as commands)
COMMAND_OF_EVENT = {
    "OrderCreated": "create",
    "OrderConfirmed": "confirm",
    "OrderShipped": "ship",
    "OrderDelivered": "deliver",
    "OrderCancelled": "cancel",
}
_OUT = tuple(c.strip().split(" ")[0] for c in ORDER_COMMAND_RESULT_DDL.split(","))


def decide(status: str | None, command: str, oid: str) -> tuple[bool, str | None, str | None, str | None]:
    """One command against the current status → (accepted, event, new status, message)."""
    if command == "create":
        if status is not None:
            return False, None, status, config.MSG_ALREADY_EXISTS.format(oid=oid)
        return True, "OrderCreated", "PENDING", None
    if status is None:
        return False, None, None, config.MSG_NOT_FOUND.format(oid=oid)
    if command == "cancel":
        if status in ("SHIPPED", "DELIVERED"):
            return False, None, status, config.MSG_CANNOT_CANCEL.format(oid=oid, status=status)
        if status == "CANCELLED":
            return True, None, status, config.MSG_ALREADY_CANCELLED.format(oid=oid)
        return True, "OrderCancelled", "CANCELLED", None
    if command in TRANSITIONS:
        expected, event, new = TRANSITIONS[command]
        if status != expected:
            return False, None, status, config.MSG_WRONG_STATUS.format(
                op=command, oid=oid, status=status, expected=expected)
        return True, event, new, None
    return False, None, status, f"Unknown command {command}"


class OrderCommandFold(KeyedFold):
    key_cols = ("order_id",)
    out_cols = _OUT
    computed_cols = ("accepted", "emitted_event", "status_before", "status_after", "message")

    def init_state(self, key):
        return {"status": None}

    def fold_batch(self, pdf, carry):
        oids, cmds = pdf["order_id"].tolist(), pdf["command"].tolist()
        n = len(oids)
        accepted, events, before, after, msgs = [None] * n, [None] * n, [None] * n, [None] * n, [None] * n
        cur, status = carry[0], (carry[1] or {}).get("status")
        for i in range(n):
            if oids[i] != cur:
                cur, status = oids[i], None
            before[i] = status
            accepted[i], events[i], status, msgs[i] = decide(status, cmds[i], oids[i])
            after[i] = status
        carry[0], carry[1] = cur, {"status": status}
        return {"accepted": accepted, "emitted_event": events, "status_before": before,
                "status_after": after, "message": msgs}

    def step(self, state, row):
        before = state["status"]
        ok, event, after, msg = decide(before, row["command"], row["order_id"])
        state["status"] = after
        return {"order_id": row["order_id"], "seq": int(row["seq"]), "command": row["command"],
                "ts": row["ts"], "accepted": ok, "emitted_event": event,
                "status_before": before, "status_after": after, "message": msg}


def handle_order_commands(commands: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``commands`` (order_id, seq, command, ts) → one decision row per command."""
    return keyed_fold(commands.select("order_id", "seq", "command", "ts"), ["order_id"], ["seq", "ts"],
                      OrderCommandFold(), ORDER_COMMAND_RESULT_DDL, num_partitions)


def commands_from_journal(journal: DataFrame) -> DataFrame:
    """Replay a journal as commands (each event re-issued as its command)."""
    c = F.col("event_type")
    cmd = None
    for ev, name in COMMAND_OF_EVENT.items():
        cmd = F.when(c == ev, F.lit(name)) if cmd is None else cmd.when(c == ev, F.lit(name))
    return journal.select("order_id", "seq", cmd.alias("command"), "ts")
