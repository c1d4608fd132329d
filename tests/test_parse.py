"""Decoding, quarantine, routing, SKU extraction, order ⟕ stock and notifications."""
import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.jsonfmt import extract_skus, items_to_json
from ledgerline.operators import notify as N
from ledgerline.operators import parse as P
from ledgerline.operators import stock_view as V

REC_DDL = "topic string, key string, value string"
CREATED = json.dumps({"orderId": "o1", "customerId": "c1", "totalAmount": 19.98,
                      "createdAt": "2024-01-01T10:00:00Z",
                      "items": [{"productId": "p", "productName": "W", "quantity": 2, "unitPrice": 9.99}]})
STATUS = json.dumps({"orderId": "o1", "customerId": "c1", "status": "x", "totalAmount": 19.98,
                     "updatedAt": "2024-01-01T11:00:00Z"})


def test_parse_and_quarantine(spark):
    recs = spark.createDataFrame([
        ("order.created", "1", CREATED),
        ("order.shipped", "2", STATUS),
        ("order.created", "3", "{"),
        ("order.confirmed", "4", json.dumps({"orderId": "o1"})),
        ("order.unknown", "5", STATUS),
        ("order.created", "6", CREATED.replace("2024-01-01T10:00:00Z", "yesterday")),
    ], REC_DDL)
    parsed = {r.key: r for r in P.parse_order_event(recs).collect()}
    assert parsed["1"].ok and parsed["1"].status == "created" and len(parsed["1"].items) == 1
    assert parsed["1"].event_time == datetime(2024, 1, 1, 10) and parsed["1"].total_amount == Decimal("19.98")
    assert parsed["2"].ok and parsed["2"].status == "shipped" and parsed["2"].items == []
    assert parsed["3"].error == "malformed_json"
    assert parsed["4"].error == "missing_field:customerId"
    assert parsed["5"].ok and parsed["5"].status == "order.unknown"     # unknown topic → itself
    assert parsed["6"].error == "bad_timestamp"
    valid, bad = P.quarantine(P.parse_order_event(recs))
    assert valid.count() == 3 and bad.count() == 3
    dlq = N.dead_letter(P.parse_order_event(recs)).collect()
    assert {(r.key, r.value) for r in dlq} == {(r.key, r.value) for r in recs.where("key in ('3','4','6')").collect()}


def test_decode_counters_are_observed(spark):
    from pyspark.sql import Observation
    recs = spark.createDataFrame([("order.created", "1", CREATED), ("order.created", "2", "{"),
                                  ("order.confirmed", "3", json.dumps({"orderId": "o1"}))], REC_DDL)
    obs = Observation("decode")
    valid, _ = P.quarantine(P.observe_decoding(P.parse_order_event(recs), obs))
    assert valid.count() == 1
    got = obs.get
    assert (got["records"], got["malformed_json"], got["missing_field"], got["bad_timestamp"]) == (3, 1, 1, 0)


def test_envelope_and_routing(spark):
    created = json.dumps({"orderId": "o1", "customerId": "c", "totalAmount": 1, "shippingAddress": "s",
                          "createdAt": "2024-01-01T00:00:00Z",
                          "items": [{"productId": "A", "quantity": 2}, {"productId": "B", "quantity": 1}]})
    recs = spark.createDataFrame([
        ("order-events", "o1", json.dumps({"eventType": "ORDER_CREATED", "payload": created})),
        ("order-events", "o1", json.dumps({"eventType": "ORDER_CANCELLED",
                                           "payload": json.dumps({"orderId": "o1", "reason": "r"})})),
        ("order-events", "o2", json.dumps({"payload": "{}"})),
        ("order-events", "o3", json.dumps({"eventType": "ORDER_SHIPPED", "payload": "{}"})),
        ("order-events", "o4", "{"),
    ], REC_DDL)
    env = P.parse_envelope(recs)
    types = [r.event_type for r in env.orderBy("key").collect()]
    assert "UNKNOWN" in types
    routes = P.route_by_event_type(env)
    cmds = sorted((r.product_id, r.kind, r.quantity) for r in routes["commands"].collect())
    assert cmds == [("A", "reserve", 2), ("B", "reserve", 1)]
    assert [r.event_type for r in routes["empty"].collect()] == ["ORDER_CANCELLED"]
    assert routes["ignored"].count() == 2
    fixed = P.recover_items(env.where("event_type = 'ORDER_CANCELLED'"),
                            env.where("event_type = 'ORDER_CREATED'").select("order_id", "items"))
    rel = sorted((r.product_id, r.kind) for r in P.route_by_event_type(fixed)["commands"].collect())
    assert rel == [("A", "release"), ("B", "release")]
    assert env.where("key = 'o4'").first().error == "malformed_json"


def test_redelivered_records_are_dropped(spark):
    recs = spark.createDataFrame([("order-events", 0, 7, "a"), ("order-events", 0, 7, "a"),
                                  ("order-events", 1, 7, "b")], "topic string, partition int, offset long, value string")
    assert P.dedupe_records(recs).count() == 2


def test_validation(spark):
    item = "struct<product_id:string,product_name:string,quantity:int,unit_price:decimal(19,4)>"
    df = spark.createDataFrame([
        ("o1", "c", "addr", [("p", "W", 2, Decimal("9.99"))]),
        ("o2", " ", "addr", []),
        ("o3", "c", "addr", [("p", "", 0, Decimal("0"))]),
    ], f"order_id string, customer_id string, shipping_address string, items array<{item}>")
    v = {r.order_id: r for r in P.validate_orders(df).collect()}
    assert v["o1"].valid and v["o1"].total_amount == Decimal("19.98")
    assert set(v["o2"].reasons) == {"customer_id_blank", "items_empty"}
    assert set(v["o3"].reasons) == {"product_name_blank", "quantity_below_1", "unit_price_not_positive"}


def test_validation_over_lines_matches_array_form(spark):
    from ledgerline.sources import domain as D
    from ledgerline.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    created = D.order_created(t)
    a = P.validate_orders(created).select("order_id", "valid", F.array_join("reasons", ",").alias("r"),
                                          "total_amount")
    b = P.validate_order_lines(created.select("order_id", "customer_id", "shipping_address"),
                               D.order_lines(t)).select("order_id", "valid",
                                                        F.array_join("reasons", ",").alias("r"), "total_amount")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_items_json_is_valid_json(spark):
    item = "struct<product_id:string,product_name:string,quantity:int,unit_price:decimal(19,4)>"
    df = spark.createDataFrame([([("p\"1", "a\\b", 2, Decimal("9.99"))],), (None,)], f"items array<{item}>")
    out = [r.j for r in df.select(items_to_json("items").alias("j")).collect()]
    assert json.loads(out[0])[0]["productId"] == 'p"1' and json.loads(out[0])[0]["productName"] == "a\\b"
    assert out[1] == "[]"


def test_sku_case_and_missing_stock(spark):
    doc = json.dumps({"items": [{"sku": "ab-1"}, {"sku": "AB-1"}, {"sku": " "}],
                      "lineItems": [{"sku": "zz-9"}], "orderItems": [{"productId": "P7"}]})
    docs = spark.createDataFrame([("o1", doc)], "order_id string, doc string")
    raw = docs.select(extract_skus("doc").alias("s")).first().s
    assert raw == ["ab-1", "AB-1", "zz-9", "P7"]
    skus = sorted((r.sku_key, r.sku) for r in V.distinct_skus(docs).collect())
    assert skus == [("ab-1", "ab-1"), ("p7", "P7"), ("zz-9", "zz-9")]
    stock = spark.createDataFrame([("AB-1", 5, 1, 6), ("p7", 2, 0, 2)],
                                  "product_id string, available long, reserved long, total long")
    rows = {r.sku: r for r in V.order_with_stock(docs, stock).collect()}
    assert rows["ab-1"].available == 5 and rows["ab-1"].stock_status == 200
    assert rows["zz-9"].stock_status == 404 and rows["zz-9"].available is None   # order kept
    m = V.as_map(V.order_with_stock(docs, stock)).first()
    assert set(m.stock) == {"ab-1", "zz-9", "P7"}


def test_notifications(spark):
    ev = spark.createDataFrame([
        ("OrderShipped", "o1", "a@x", "SHIPPED", "TRK-1", None, "https://h"),
        ("OrderCancelled", "o2", "b@x", "CANCELLED", None, "Too late", ""),
        ("OrderCreated", "o3", "c@x", "PENDING", None, None, None),
        ("OrderDelivered", "o4", "d@x", "DELIVERED", None, None, None),
    ], "event_type string, order_id string, customer_email string, status string, tracking_number string, "
       "cancellation_reason string, webhook_url string")
    mails = {r.order_id: r for r in N.order_notifications(ev).collect()}
    assert mails["o1"].body == "Order o1 is on its way! Tracking: TRK-1"
    assert mails["o2"].subject == "Your order has been cancelled" and mails["o2"].body.endswith("Reason: Too late")
    assert "o4" not in mails
    dflt = {r.order_id: r for r in N.order_notifications(ev, use_default=True).collect()}
    assert dflt["o4"].subject == "Order update" and dflt["o4"].body == "Update on order o4: OrderDelivered"
    hooks = N.webhook_payloads(ev).collect()
    assert len(hooks) == 1 and json.loads(hooks[0].payload) == {"eventType": "OrderShipped", "OrderId": "o1",
                                                                "Status": "SHIPPED"}
    routes = N.route_notifications(ev)
    assert routes["unknown"].first().order_id == "o4" and routes["order"].count() == 3
    view = spark.createDataFrame([("p1", "Bolt", 3), ("p2", "Nut", 300)],
                                 "product_id string, product_name string, available long")
    low = N.low_stock_notifications(N.low_stock_events(view, threshold=10)).collect()
    assert len(low) == 1 and low[0].subject == "Low stock alert: Bolt"
    assert low[0].body == "Product 'Bolt' (ID: p1) has only 3 units remaining. Please restock."


def test_rate_windows(spark):
    base = datetime(2024, 1, 1, 10)
    rows = [(1, base.replace(second=s)) for s in range(0, 50, 10)] + [(2, base.replace(minute=5))]
    ev = spark.createDataFrame(rows, "user_id long, ts timestamp")
    from ledgerline.operators import rates as R
    fixed = R.fixed_window_breaches(ev, limit=3, seconds=60, key="user_id").collect()
    assert len(fixed) == 1 and fixed[0].user_id == 1 and fixed[0].request_count == 5 and fixed[0].excess == 2
    sliding = R.sliding_window_breaches(ev, limit=4, seconds=60, segments=6).collect()
    assert {r.request_count for r in sliding} == {5}
    assert F is not None


def test_every_envelope_is_routed_or_dead_lettered(spark):
    rows = [("{",), (None,), ('{"eventType":"ORDER_CREATED","payload":"{"}',), ('{"eventType":"OTHER","payload":"{}"}',),
            ('{"eventType":"ORDER_CANCELLED","payload":"{\\"orderId\\":\\"1\\",\\"reason\\":\\"r\\"}"}',)]
    routes = P.route_by_event_type(P.parse_envelope(spark.createDataFrame(rows, "value string")))
    assert {k: routes[k].count() for k in ("commands", "empty", "ignored", "bad")} == {"commands": 0, "empty": 1, "ignored": 1, "bad": 3}


def test_documents_without_skus_keep_their_order_and_spellings_are_one_sku(spark):
    from ledgerline.operators import stock_view as V
    docs = spark.createDataFrame([("1", '{"items":[]}'), ("2", "no json"), ("3", '{"items":[{"sku":"A"},{"sku":"a"}]}')], "order_id string, doc string")
    stock = spark.createDataFrame([("A", 1, 0, 1), ("a", 2, 1, 3)], "product_id string, available int, reserved int, total int")
    got = sorted((r.order_id, r.sku, r.available, r.stock_status) for r in V.order_with_stock(docs, stock).collect())
    assert got == [("1", None, None, None), ("2", None, None, None), ("3", "A", 3, 200)]
    assert {r.order_id: len(r.stock) for r in V.as_map(V.order_with_stock(docs, stock)).collect()} == {"1": 0, "2": 0, "3": 1}


def test_control_characters_survive_the_item_json(spark):
    from ledgerline.functions.jsonfmt import extract_skus, items_to_json
    df = spark.sql("SELECT array(struct('a\\nb\\t\"c' AS product_id, cast(null as string) AS product_name, 1 AS quantity, cast(1 as decimal(19,4)) AS unit_price)) AS items")
    doc = df.select(F.concat(F.lit('{"items":'), items_to_json("items"), F.lit("}")).alias("doc"))
    assert doc.select(extract_skus("doc").alias("s")).first().s == ['a\nb\t"c']


def test_commands_without_a_product_do_not_stop_the_fold(spark):
    from ledgerline.operators import inventory as I
    rows = [(None, "reserve", "o1", 1, 1), ("A", "replenish", None, 5, 0), ("A", "reserve", "o1", 2, 1)]
    df = spark.createDataFrame([(p, k, o, q, None, s) for p, k, o, q, s in rows], "product_id string, kind string, order_id string, quantity int, ts timestamp, seq long")
    got = {(r.product_id, r.kind): r.ok for r in I.apply_stock_commands(df.coalesce(1), 1).collect()}
    assert got == {(None, "reserve"): False, ("A", "replenish"): True, ("A", "reserve"): True}


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest
    from ledgerline import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_envelopes_read_the_lines_once_and_equal_the_join_with_created(spark):
    from ledgerline.plans import catalog as C
    from ledgerline.sources import domain as D
    from ledgerline.sources import topics as TP
    from ledgerline.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    env = C._envelopes(t)
    scans = [line for line in env._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1
    joined = TP.publish_order_events(D.order_journal(t), D.order_created(t))
    assert env.exceptAll(joined).count() == 0 and joined.exceptAll(env).count() == 0


def test_recovered_commands_decode_each_envelope_once(spark):
    from ledgerline.plans import catalog as C
    df = C.q_k9_recovered_commands(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "from_json" not in plan and "l_orderkey" not in plan
