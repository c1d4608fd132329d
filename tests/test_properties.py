"""Property tests: the two state machines and the range-scan bounds (pure Python)."""
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.commands import decide
from ledgerline.operators.inventory import StockFold
from ledgerline.operators.metrics import window_scan_bounds

LEGAL = {(None, "PENDING"), ("PENDING", "CONFIRMED"), ("CONFIRMED", "SHIPPED"), ("SHIPPED", "DELIVERED"),
         ("PENDING", "CANCELLED"), ("CONFIRMED", "CANCELLED")}

commands = st.lists(st.sampled_from(["create", "confirm", "ship", "deliver", "cancel"]), max_size=12)


@given(commands)
@settings(max_examples=300, deadline=None)
def test_order_state_machine(cmds):
    status = None
    for c in cmds:
        ok, event, after, msg = decide(status, c, "o")
        if not ok:
            assert after == status and event is None and msg       # rejected: unchanged, with a reason
        elif event is None:
            assert c == "cancel" and status == "CANCELLED" == after  # the silent duplicate cancel
        else:
            assert (status, after) in LEGAL
        status = after


stock_cmds = st.lists(st.tuples(st.sampled_from(["reserve", "release", "confirm", "replenish"]),
                                st.sampled_from(["o1", "o2", "o3", "o4"]),
                                st.integers(min_value=-2, max_value=12)), max_size=40)


@given(stock_cmds)
@settings(max_examples=300, deadline=None)
def test_stock_ledger_invariants(cmds):
    state = StockFold().init_state(("p",))
    replenished = confirmed = 0
    for kind, oid, q in cmds:
        before = (state["available"], dict(state["reservations"]))
        ok, applied, eff, msg = StockFold._apply(state, "p", kind, oid, q)
        assert state["available"] >= 0
        assert state["reserved"] == sum(state["reservations"].values())
        if not ok:
            assert (state["available"], state["reservations"]) == before and msg
        if applied and kind == "replenish":
            replenished += eff
        if applied and kind == "confirm":
            confirmed += eff
        if kind == "reserve" and oid in before[1]:
            assert ok and not applied and eff == before[1][oid]   # idempotent (q10)
        assert replenished - confirmed == state["available"] + state["reserved"]

BASE = datetime(2024, 1, 1)
minutes = st.integers(min_value=0, max_value=60 * 24 * 10)


@given(minutes, minutes, st.integers(min_value=0, max_value=60 * 24 * 10 * 60),
       st.sampled_from([3600, 7200, 1800]))
@settings(max_examples=500, deadline=None)
def test_scan_bounds_keep_every_contained_window(a, b, t, duration):
    """An event whose window lies inside [from, to] is always inside the scanned [lo, hi)."""
    frm, to = BASE + timedelta(minutes=min(a, b)), BASE + timedelta(minutes=max(a, b) + 1)
    ts = BASE + timedelta(seconds=t)
    start = ts.replace(minute=0, second=0, microsecond=0)
    end = start + timedelta(seconds=duration)
    lo, hi = window_scan_bounds(frm, to, duration)
    if start >= frm and end <= to:
        assert lo <= ts < hi
