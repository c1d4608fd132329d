"""Order aggregate cases (the reference's seven) plus replay / audit / listing."""
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import commands as K
from ledgerline.operators import orders as O
from ledgerline.operators.commands import decide

T0 = datetime(2024, 1, 1, 9)
JOURNAL_DDL = ("order_id string, seq long, event_type string, ts timestamp, customer_id string, "
               "total_amount decimal(19,4), tracking_number string, carrier string, reason string")


def fold(spark, cmds):
    rows = [("order-123", i, c, T0 + timedelta(minutes=i)) for i, c in enumerate(cmds)]
    df = spark.createDataFrame(rows, "order_id string, seq long, command string, ts timestamp")
    return [r.asDict() for r in K.handle_order_commands(df).orderBy("seq").collect()]


# the seven cases: prior events → command → result
@pytest.mark.parametrize("prior,command,accepted,event", [
    ([], "create", True, "OrderCreated"),
    (["create"], "confirm", True, "OrderConfirmed"),
    (["create", "confirm"], "confirm", False, None),
    (["create"], "cancel", True, "OrderCancelled"),
    (["create", "confirm", "ship"], "cancel", False, None),
    (["create", "confirm", "ship"], "deliver", True, "OrderDelivered"),
    (["create"], "ship", False, None),
])
def test_reference_aggregate_cases(spark, prior, command, accepted, event):
    out = fold(spark, prior + [command])
    assert all(r["accepted"] for r in out[:-1])
    last = out[-1]
    assert last["accepted"] is accepted and last["emitted_event"] == event
    if not accepted:
        assert last["status_after"] == last["status_before"]


def test_created_total_is_sum_of_line_totals(spark):
    from ledgerline.functions.columns import order_total
    df = spark.createDataFrame([([("prod-1", "Widget", 2, Decimal("9.99"))],)],
                               "items array<struct<product_id:string,product_name:string,quantity:int,"
                               "unit_price:decimal(19,4)>>")
    assert df.select(order_total("items").alias("t")).first().t == Decimal("19.98")
    empty = spark.createDataFrame([([],)], df.schema)
    assert empty.select(order_total("items").alias("t")).first().t == Decimal("0")


def test_cancel_twice_is_one_event(spark):
    out = fold(spark, ["create", "cancel", "cancel"])
    assert [r["emitted_event"] for r in out] == ["OrderCreated", "OrderCancelled", None]
    assert out[2]["accepted"] and out[2]["status_after"] == "CANCELLED"


def test_command_without_created_is_rejected():
    assert decide(None, "confirm", "x")[0] is False
    assert decide("PENDING", "create", "x")[0] is False


def journal(spark, rows):
    return spark.createDataFrame(rows, JOURNAL_DDL)


def test_replay_state_and_orphans(spark):
    j = journal(spark, [
        ("a", 0, "OrderCreated", T0, "c1", Decimal("10"), None, None, None),
        ("a", 1, "OrderConfirmed", T0 + timedelta(1), None, None, None, None, None),
        ("a", 2, "OrderShipped", T0 + timedelta(2), None, None, "TRK-001", "FedEx", None),
        ("b", 1, "OrderConfirmed", T0, None, None, None, None, None),   # orphan
    ])
    st = {r.order_id: r for r in O.replay_order_state(j).collect()}
    assert set(st) == {"a"}
    assert st["a"].status == "SHIPPED" and st["a"].tracking_number == "TRK-001" and st["a"].carrier == "FedEx"
    assert st["a"].customer_id == "c1" and st["a"].created_at == T0
    assert O.orphan_status_events(j).select("order_id").collect()[0].order_id == "b"
    assert O.state_at(j, T0 + timedelta(hours=30)).first().status == "CONFIRMED"


def test_illegal_transitions(spark):
    j = journal(spark, [
        ("a", 0, "OrderCreated", T0, "c", Decimal("1"), None, None, None),
        ("a", 1, "OrderConfirmed", T0, None, None, None, None, None),
        ("a", 2, "OrderShipped", T0, None, None, "t", "UPS", None),
        ("a", 3, "OrderCancelled", T0, None, None, None, None, "Too late"),
        ("b", 1, "OrderConfirmed", T0, None, None, None, None, None),
    ])
    bad = {(r.order_id, r.seq): (r.from_status, r.to_status) for r in O.illegal_transitions(j).collect()}
    assert bad == {("a", 3): ("SHIPPED", "CANCELLED"), ("b", 1): (None, "CONFIRMED")}


def test_list_orders_paging_and_find(spark):
    rows = [(f"o{i}", "c1" if i % 2 else "c2", "PENDING", T0 + timedelta(days=i)) for i in range(7)]
    s = spark.createDataFrame(rows, "order_id string, customer_id string, status string, created_at timestamp")
    page = [r.order_id for r in O.list_orders(s, customer_id="c1", page=0, size=2).collect()]
    assert page == ["o5", "o3"]
    page2 = [r.order_id for r in O.list_orders(s, customer_id="c1", page=1, size=2).collect()]
    assert page2 == ["o1"]
    whole = O.list_orders(s, customer_id="c1", size=100).collect()
    for i, r in enumerate(whole):
        behind = O.list_orders(s, customer_id="c1", size=2, after=(r.created_at, r.order_id)).collect()
        assert behind == whole[i + 1:i + 3]
    fetched = []

    def details(keys):
        fetched.append(keys)
        return s.where(F.col("order_id").isin(keys))

    late = O.list_orders_late(s.select("order_id", "customer_id", "status", "created_at"), details, customer_id="c1", page=1, size=2)
    assert late.collect() == whole[2:4] and fetched == [page2]
    assert O.list_orders_late(s, details, customer_id="nobody").count() == 0
    with pytest.raises(ValueError):
        O.list_orders_late(s, details, size=O.MAX_PAGE + 1)
    assert O.find_order(s, "o4", check=True).count() == 1
    with pytest.raises(LookupError):
        O.find_order(s, "nope", check=True)
    with pytest.raises(ValueError):
        O.list_orders(s, size=0)


def test_status_update_skips_unknown_orders(spark):
    j = journal(spark, [("a", 0, "OrderCreated", T0, "c", Decimal("1"), None, None, None),
                        ("a", 1, "OrderConfirmed", T0, None, None, None, None, None),
                        ("z", 1, "OrderConfirmed", T0, None, None, None, None, None)])
    assert [r.order_id for r in O.status_updates(j).collect()] == ["a"]
    enriched = O.enrich_status_events(j).collect()
    assert {r.order_id for r in enriched} == {"a"} and len(enriched) == 2


def test_journal_fold_matches_replay(spark):
    """For created orders, replaying the journal as commands rejects exactly the illegal events.

    (Events of orphan orders are all rejected by the fold — the aggregate does
    not exist — while the transition audit flags only their first event.)"""
    from ledgerline.sources import domain as D
    from ledgerline.sources.tables import Tables
    j = D.order_journal(Tables(spark, "/root/testdata/sf0.001"))
    res = K.handle_order_commands(K.commands_from_journal(j))
    created = j.where("event_type = 'OrderCreated'").select("order_id")
    rejected = res.where(~F.col("accepted")).select("order_id", "seq").join(created, "order_id", "left_semi")
    illegal = O.illegal_transitions(j).select("order_id", "seq").join(created, "order_id", "left_semi")
    assert illegal.count() > 0
    assert rejected.exceptAll(illegal).count() == 0 and illegal.exceptAll(rejected).count() == 0
