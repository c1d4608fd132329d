"""Batch = stream (availableNow over files split in 3), keyed sink idempotency, late data."""
import json
import os
import time
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import inventory as I
from ledgerline.operators import inventory as I
from ledgerline.operators import metrics as M
from ledgerline.sources import domain as D
from ledgerline.sources.sinks import KeyedTable, HOURLY_METRICS_SCHEMA, hourly_metrics_table
from ledgerline.sources.tables import Tables
from ledgerline.streaming import metrics_stream as MS
from ledgerline.streaming import stateful as ST

SF = "/root/testdata/sf0.001"


def split_in_three(df, ts_col, path):
    """Three time-ordered chunks written one after the other (file order = time order)."""
    bounds = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    step = (hi - lo) / 3
    cuts = [lo, lo + step, lo + 2 * step, hi]
    for i in range(3):
        cond = (F.col(ts_col) >= cuts[i]) & ((F.col(ts_col) < cuts[i + 1]) if i < 2 else F.lit(True))
        df.where(cond).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hourly_metrics_batch_equals_stream(spark, workdir):
    t = Tables(spark, SF)
    src = os.path.join(workdir, "events")
    split_in_three(t.events, "ts", src)
    stream = spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", "1").parquet(src)
    hourly, top = MS.run_metrics_stream(spark, D.normalise_events(stream), D.event_items(stream),
                                          os.path.join(workdir, "out"), watermark="1 hour")
    assert same(hourly.read(spark), M.hourly_metrics(D.metric_events(t)).select(*HOURLY_METRICS_SCHEMA.fieldNames()))
    assert same(top.read(spark), M.product_window_rows(D.metric_event_items(t)))
    versions = spark.read.parquet(hourly.path).select("batch_id").distinct().count()
    assert versions >= 3     # one version per micro-batch (+ the empty version of ensure)


def test_stock_fold_batch_equals_stream(spark, workdir):
    cmds = D.stock_commands(Tables(spark, SF))
    src = os.path.join(workdir, "cmds")
    split_in_three(cmds, "ts", src)
    stream = spark.readStream.schema(cmds.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out = os.path.join(workdir, "fold")
    before = spark.conf.get(ST.PROVIDER_KEY, None)
    q = ST.start_with_rocksdb(spark, ST.stock_fold_stream(stream).writeStream.format("parquet").option("path", out)
                              .option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True))
    q.awaitTermination()
    assert spark.conf.get(ST.PROVIDER_KEY, None) == before
    streamed = spark.read.parquet(out)
    batch = I.apply_stock_commands(cmds)
    assert same(streamed.select(*batch.columns), batch)


def test_the_stock_state_holds_open_reservations_only(spark, workdir):
    """Eight triggers of reservations, all but the last trigger's closed by the next: the state does not grow."""
    ddl = "product_id string, kind string, order_id string, quantity int, ts timestamp, seq long, line_no int"
    src, ck, out = (os.path.join(workdir, d) for d in ("src", "ck", "out"))
    for b in range(8):
        at = datetime(2024, 1, 1, 0, b)
        rows = [("p", "replenish", None, 100, at, 0, None), (None, "replenish", None, 5, at, 0, None)] if b == 0 else []
        rows += [("p", "release" if b % 2 else "confirm", f"o{b - 1}-{i}", None, at, 1, i) for i in range(3) if b]
        rows += [("p", "reserve", f"o{b}-{i}", 2, at, 2, i) for i in range(3)]
        rows += [("p", "reserve", f"o{b}-0", 9, at, 3, 0), ("p", "reserve", f"big{b}", 1000, at, 4, 0)]
        spark.createDataFrame(rows[::-1], ddl).coalesce(1).write.mode("append").parquet(src)
    cmds = spark.read.schema(ddl).parquet(src)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(src)
    q = ST.start_with_rocksdb(spark, ST.stock_fold_stream(stream).writeStream.format("parquet").option("path", out)
                              .option("checkpointLocation", ck).trigger(availableNow=True))
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 7
    batch = I.apply_stock_commands(cmds)
    assert same(spark.read.parquet(out).select(*batch.columns), batch)
    state = spark.read.format("statestore").option("stateVarName", "reservations").load(ck)
    assert sorted(r[0] for r in state.select("user_map_key.order_id").collect()) == ["o7-0", "o7-1", "o7-2"]


def test_order_commands_batch_equals_stream(spark, workdir):
    from ledgerline.operators import commands as K
    cmds = K.commands_from_journal(D.order_journal(Tables(spark, SF)))
    src = os.path.join(workdir, "ocmds")
    split_in_three(cmds, "ts", src)
    stream = spark.readStream.schema(cmds.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out = os.path.join(workdir, "ofold")
    q = (ST.order_command_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(workdir, "ock")).trigger(availableNow=True).start())
    q.awaitTermination()
    batch = K.handle_order_commands(cmds)
    assert same(spark.read.parquet(out).select(*batch.columns), batch)


def test_keyed_table_upsert_is_idempotent(spark, workdir):
    tbl = hourly_metrics_table(os.path.join(workdir, "t"))
    tbl.ensure(spark)
    w = datetime(2024, 1, 1, 10)
    b1 = spark.createDataFrame([(w, w.replace(hour=11), 2, Decimal("10"), 5.0)], HOURLY_METRICS_SCHEMA)
    b2 = spark.createDataFrame([(w, w.replace(hour=11), 3, Decimal("15"), 5.0)], HOURLY_METRICS_SCHEMA)
    tbl.upsert(b1, 0)
    tbl.upsert(b1, 0)                      # retried batch: same result
    assert tbl.read(spark).first().order_count == 2
    tbl.upsert(b2, 1)                      # later batch: true window total replaces
    rows = tbl.read(spark).collect()
    assert len(rows) == 1 and rows[0].order_count == 3 and rows[0].total_revenue == Decimal("15")
    tbl.upsert(b2, 1)
    assert tbl.read(spark).first().order_count == 3
    assert isinstance(tbl, KeyedTable)


def test_an_upsert_reads_and_writes_what_it_touches(spark, workdir):
    import random
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("k string, v long, live boolean")
    tbl = KeyedTable(os.path.join(workdir, "touch"), ["k"], schema, buckets=8, keep="live")
    tbl.ensure(spark)
    rng, truth, sizes = random.Random(3), {}, []
    for n in range(7):
        rows = {f"k{rng.randrange(40)}": (n, rng.random() > 0.3) for _ in range(5)}
        before = tbl.versions(spark)
        batch = spark.createDataFrame([(k, v, live) for k, (v, live) in rows.items()], schema)
        for _ in range(1 + (n == 3)):  # one batch is retried
            tbl.upsert(batch, n)
        truth = {k: v for k, v in truth.items() if k not in rows} | {k: v for k, (v, live) in rows.items() if live}
        assert {r.k: r.v for r in tbl.read(spark).collect()} == truth
        after, touched = tbl.versions(spark), tbl.touched(batch)
        assert all(after[b] == before.get(b) for b in after if b not in touched)  # the other partitions are as they were
        sizes.append(max(len(v) for v in after.values()))
    assert max(sizes) <= 2  # this version of a partition and the one before, after any number of batches


def test_offset_intervals(spark):
    from ledgerline.streaming import reservations as RS
    ddl, seen_ddl = "topic string, partition int, offset long", "topic string, partition int, seen array<struct<lo:long,hi:long>>"
    seen, batches, truth = spark.createDataFrame([], seen_ddl), [[1, 2, 3], [5, 6, 9], [4, 9, 2], [7, 8, 20], [10]], set()
    for offsets in batches:
        records = spark.createDataFrame([("t", 0, o) for o in offsets] + [("t", 0, offsets[0]), ("t", None, 1)], ddl)
        got = [r.offset for r in RS.unseen(records, seen).collect() if r.partition is not None]
        assert sorted(got) == sorted(set(offsets) - truth)
        truth |= set(offsets)
        seen = spark.createDataFrame(RS.with_offsets(seen, records).collect(), seen_ddl)
    assert [[tuple(s) for s in r.seen] for r in seen.collect()] == [[(1, 10), (20, 20)]]


def test_a_cancel_that_comes_before_its_created_waits_for_it(spark, workdir):
    from ledgerline.streaming import reservations as RS
    ddl = "topic string, key string, value string, partition int, offset long, timestamp timestamp"
    stock = spark.createDataFrame([("A", 10)], "product_id string, available int")
    state, kept = RS.StockState(os.path.join(workdir, "wait")), RS.ConsumerState(os.path.join(workdir, "wait"))
    state.ensure(spark)
    kept.ensure(spark)
    cancel = ("order-events", "o1", envelope("ORDER_CANCELLED", orderId="o1", reason="r"), 0, 7, datetime(2024, 1, 2))
    made = ("order-events", "o1", created("o1", ("A", 5)), 0, 8, datetime(2024, 1, 1))
    other = ("order-events", "o2", envelope("ORDER_SHIPPED", orderId="o2"), 0, 9, datetime(2024, 1, 1))
    for n, rows in enumerate([[cancel], [made, cancel], [cancel, other]]):
        batch = spark.createDataFrame(rows, ddl)
        for _ in range(1 + (n == 1)):  # one batch is retried
            RS.consume_batch(spark, batch, n, state, kept, stock)
        assert kept.pending.read(spark).count() == (1 if n == 0 else 0)
    assert [(r.available, r.reserved) for r in RS.read_stock(spark, state.base).collect()] == [(10, 0)]
    assert [r.warning for r in spark.read.parquet(f"{state.base}/warnings").collect()] == ["ignored"]


def test_late_event_beyond_watermark_is_dropped(spark, workdir):
    """Spark drops rows older than the previous batch's watermark (and counts them)."""
    schema = "order_id string, customer_id string, total_amount decimal(19,4), status string, event_time timestamp"
    src = os.path.join(workdir, "late")
    files = [[("a", datetime(2024, 1, 1, 10)), ("b", datetime(2024, 1, 1, 15))],
             [("d", datetime(2024, 1, 1, 14, 30))],          # within the 1 h watermark
             [("c", datetime(2024, 1, 1, 10, 30))]]          # far behind: dropped
    for rows in files:
        spark.createDataFrame([(o, "c", Decimal("1"), "created", ts) for o, ts in rows], schema) \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src)
    tbl = hourly_metrics_table(os.path.join(workdir, "lt"))
    tbl.ensure(spark)
    q = MS.start_upsert(MS.hourly_metrics_stream(stream, "1 hour"), tbl, os.path.join(workdir, "lck"))
    q.awaitTermination()
    got = {r.window_start.hour: r.order_count for r in tbl.read(spark).collect()}
    assert got == {10: 1, 14: 1, 15: 1}
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_order_summary_stream_equals_replay(spark, workdir):
    from ledgerline.operators import orders as O
    from ledgerline.streaming import projection as PR
    j = D.order_journal(Tables(spark, SF)).select("order_id", "seq", "event_type", "ts", "customer_id",
                                                  "total_amount", "tracking_number", "carrier", "reason")
    src = os.path.join(workdir, "journal")
    split_in_three(j, "ts", src)
    stream = spark.readStream.schema(j.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out = os.path.join(workdir, "partials")
    PR.start_order_summary_stream(stream, out, os.path.join(workdir, "pck")).awaitTermination()
    streamed = PR.read_order_summary(spark, out)
    batch = O.replay_order_state(j)
    assert same(streamed, batch)
    # a re-delivered, older Created cannot reset the state (sequence guard)
    dup = j.where("event_type = 'OrderCreated'").limit(5)
    again = PR.merge_partials(spark.read.parquet(out).drop("batch_id").unionByName(PR.partial_replay(dup)))
    assert same(again, batch)


def test_saga_stream_equals_batch(spark, workdir):
    from ledgerline.operators import saga as S
    from ledgerline.plans.catalog import saga_inputs
    from ledgerline.streaming import saga_stream as SS
    ev = saga_inputs(Tables(spark, SF))
    src = os.path.join(workdir, "saga")
    split_in_three(ev, "ts", src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src)
    out = os.path.join(workdir, "saga-partials")
    SS.start_saga_stream(stream, out, os.path.join(workdir, "sck")).awaitTermination()
    assert same(SS.read_saga_status(spark, out), S.saga_status(S.saga_correlate(ev)))


def test_reservation_stream_single_batch_equals_batch(spark, workdir):
    from ledgerline.streaming import reservations as RS
    t = Tables(spark, SF)
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    src = os.path.join(workdir, "lines1")
    lines.write.parquet(src)
    stream = spark.readStream.schema(lines.schema).parquet(src)
    base = os.path.join(workdir, "res1")
    RS.start_reservation_stream(spark, stream, D.stock_initial(t), base, os.path.join(workdir, "rck1")).awaitTermination()
    batch = I.reserve_orders(lines, D.stock_initial(t), D.EPOCH)
    assert same(RS.read_outcomes(spark, base).drop("batch_id"), batch["outcome"])
    final = batch["stock"].select("product_id", "available", "reserved")
    assert same(RS.read_stock(spark, base), final)


def test_reservation_stream_batches_conserve_stock(spark, workdir):
    from ledgerline.streaming import reservations as RS
    t = Tables(spark, SF)
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    src = os.path.join(workdir, "lines3")
    split_in_three(lines, "ts", src)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", "1").parquet(src)
    base = os.path.join(workdir, "res3")
    RS.start_reservation_stream(spark, stream, D.stock_initial(t), base, os.path.join(workdir, "rck3")).awaitTermination()
    out = RS.read_outcomes(spark, base)
    assert out.select("batch_id").distinct().count() == 3
    assert out.count() == out.select("order_id").distinct().count() == lines.select("order_id").distinct().count()
    stock = RS.read_stock(spark, base)
    assert stock.where("available < 0").count() == 0
    # nothing is confirmed here, so every product keeps available + reserved = its initial stock
    init = D.stock_initial(t).select("product_id", F.col("available").alias("initial"))
    assert stock.join(init, "product_id").where("available + reserved != initial").count() == 0
    failed = out.where("NOT reserved").select("order_id")
    held = RS.StockState(base).reservations.read(spark).where("live").join(failed, "order_id", "left_semi")
    assert held.count() == 0


def test_release_after_batch_unblocks_the_next_batch(spark, workdir):
    from ledgerline.streaming import reservations as RS
    ddl = "order_id string, line_no int, product_id string, quantity int, ts timestamp, seq long"
    src = os.path.join(workdir, "fx")
    t0 = datetime(2024, 1, 1)
    for rows in ([("o1", 1, "A", 5, t0, 1), ("o1", 2, "B", 9, t0, 2)], [("o2", 1, "A", 1, t0, 3)]):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stock = spark.createDataFrame([("A", 5), ("B", 1)], "product_id string, available int")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(src)
    base = os.path.join(workdir, "fxs")
    RS.start_reservation_stream(spark, stream, stock, base, os.path.join(workdir, "fxck")).awaitTermination()
    got = {r.order_id: r.reserved for r in RS.read_outcomes(spark, base).collect()}
    assert got == {"o1": False, "o2": True}       # o1's hold on A was released after its batch
    assert {r.product_id: (r.available, r.reserved) for r in RS.read_stock(spark, base).collect()} == \
        {"A": (4, 1), "B": (1, 0)}


def test_inventory_consumer_stream_keeps_the_ledger_invariants(spark, workdir):
    from ledgerline.sources import topics as TP
    from ledgerline.streaming import reservations as RS
    t = Tables(spark, SF)
    path = os.path.join(workdir, "envelopes")
    TP.publish_order_events(D.order_journal(t), D.order_created(t)).write.parquet(path)
    base = os.path.join(workdir, "inv")
    RS.start_inventory_stream(spark, TP.read_order_envelopes(spark, path, stream=True), D.stock_initial(t), base,
                              os.path.join(workdir, "ick")).awaitTermination()
    stock = RS.read_stock(spark, base)
    assert stock.where("available < 0").count() == 0
    ledger = spark.read.parquet(os.path.join(base, "ledger"))
    confirmed = (ledger.where("kind = 'confirm' AND applied").groupBy("product_id")
                 .agg(F.sum("effective_quantity").alias("confirmed")))
    init = D.stock_initial(t).select("product_id", F.col("available").alias("initial"))
    chk = (stock.join(init, "product_id").join(confirmed, "product_id", "left")
           .where("initial - coalesce(confirmed, 0) != available + reserved"))
    assert chk.count() == 0
    assert ledger.where("kind IN ('release', 'confirm')").count() > 0     # q20: items were recovered


def test_decode_stream_equals_batch(spark, workdir):
    from ledgerline.operators import parse as P
    from ledgerline.streaming import decode_stream as DS
    recs = D.order_topic_records(Tables(spark, SF))
    src = os.path.join(workdir, "records")
    split_in_three(recs, "timestamp", src)
    stream = spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", "1").parquet(src)
    base = os.path.join(workdir, "decoded")
    DS.start_decode_stream(spark, stream, base, os.path.join(workdir, "dck")).awaitTermination()
    valid, _ = P.quarantine(P.parse_order_event(recs))
    assert same(spark.read.parquet(os.path.join(base, "events")).drop("batch_id"), valid)
    assert spark.read.parquet(os.path.join(base, "dead_letters")).count() == \
        P.parse_order_event(recs).where("NOT ok").count()


def envelope(event_type, **payload):
    return json.dumps({"eventType": event_type, "payload": json.dumps(payload)})


def created(order, *items):
    return envelope("ORDER_CREATED", orderId=order, customerId="c", totalAmount=1, shippingAddress="s", createdAt="2024-01-01T00:00:00Z",
                    items=[{"productId": p, "quantity": q} for p, q in items])


def test_inventory_stream_loses_no_late_record_and_drops_each_redelivery(spark, workdir):
    """One file per trigger, event times far apart and out of order, a redelivery, and a malformed value."""
    from ledgerline.streaming import reservations as RS
    ddl = "topic string, key string, value string, partition int, offset long, timestamp timestamp"
    src = os.path.join(workdir, "late")
    rows = [("o1", created("o1", ("A", 2)), 1, datetime(2024, 5, 1)), ("o2", created("o2", ("A", 3)), 2, datetime(2024, 1, 1)),
            ("o1", created("o1", ("A", 2)), 1, datetime(2024, 5, 1)), ("o3", "{not json", 3, datetime(2024, 5, 2)),
            ("o1", envelope("ORDER_CONFIRMED", orderId="o1", items=[]), 4, datetime(2023, 1, 1)),
            ("o2", envelope("ORDER_CANCELLED", orderId="o2", reason="r"), 5, datetime(2022, 1, 1))]
    for key, value, offset, ts in rows:
        spark.createDataFrame([("order-events", key, value, 0, offset, ts)], ddl).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(src)
    base = os.path.join(workdir, "lates")
    stock = spark.createDataFrame([("A", 10)], "product_id string, available int")
    RS.start_inventory_stream(spark, stream, stock, base, os.path.join(workdir, "latec")).awaitTermination()
    # o1 reserved and confirmed (2 gone), o2 reserved and cancelled (3 back): created items of earlier triggers were found
    assert [(r.available, r.reserved) for r in RS.read_stock(spark, base).collect()] == [(8, 0)]
    seen = RS.ConsumerState(base).offsets.read(spark).collect()
    assert [[tuple(s) for s in r.seen] for r in seen] == [[(1, 5)]]
    assert [r.key for r in spark.read.parquet(f"{base}/dead_letters").collect()] == ["o3"]


def test_a_failed_order_gives_back_what_it_holds_from_earlier_batches(spark, workdir):
    from ledgerline.streaming import reservations as RS
    ddl = "order_id string, line_no int, product_id string, quantity int, ts timestamp, seq long"
    stock = spark.createDataFrame([("A", 5), ("B", 1)], "product_id string, available int")
    state = RS.StockState(os.path.join(workdir, "giveback"))
    state.ensure(spark)
    t0 = datetime(2024, 1, 1)
    RS.reserve_batch(spark, spark.createDataFrame([("o1", 1, "A", 5, t0, 1)], ddl), 0, state, stock)
    RS.reserve_batch(spark, spark.createDataFrame([("o1", 2, "B", 9, t0, 1)], ddl), 1, state, stock)
    assert {r.product_id: (r.available, r.reserved) for r in RS.read_stock(spark, state.base).collect()} == {"A": (5, 0), "B": (1, 0)}


def test_order_records_are_not_split_by_triggers(spark, workdir):
    from ledgerline.streaming import reservations as RS
    t = Tables(spark, SF)
    lines = D.created_lines(t).select("order_id", "line_no", "product_id", "quantity", "ts", "seq")
    records = RS.order_records(lines)
    src = os.path.join(workdir, "records7")
    split_in_three(records, "ts", src)
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", "1").parquet(src)
    base = os.path.join(workdir, "res7")
    RS.start_reservation_stream(spark, stream, D.stock_initial(t), base, os.path.join(workdir, "rck7")).awaitTermination()
    batch = I.reserve_orders(lines, D.stock_initial(t), D.EPOCH)
    # the three parts follow one another in time; only compensation between batches may admit more orders
    both = RS.read_outcomes(spark, base).join(batch["outcome"].select("order_id", F.col("reserved").alias("in_batch")), "order_id")
    assert both.count() == lines.select("order_id").distinct().count() and both.where("NOT in_batch AND NOT reserved").count() > 0


def test_rate_stream_equals_batch_at_limit_zero(spark, workdir):
    from ledgerline.operators import rates as R
    from ledgerline.plans.catalog import run_rate_stream
    ev = Tables(spark, SF).events
    src = os.path.join(workdir, "rate-events")
    ev.orderBy(F.xxhash64("event_id")).repartition(3).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src)
    got = R.breaches(run_rate_stream(spark, R.fixed_window_counts_stream(stream, 3600, key="user_id"), os.path.join(workdir, "rate")), 0)
    assert same(got, R.fixed_window_breaches(ev, 0, 3600, key="user_id"))


def test_notification_sinks_hold_every_record(spark, workdir):
    from ledgerline.streaming import decode_stream as DS
    rows = [("OrderCreated", '{"OrderId":"1","CustomerEmail":"a@x"}'), ("OrderCreated", "not json"), ("OrderShipped", '{"OrderId":"2"}'), ("OrderCreated", None),
            ("OrderConfirmed", '{"CustomerEmail":"b@x"}'), ("OrderDelivered", '{"OrderId":"1"}'), ("InventoryLow", "{}"), (None, "x")]
    DS.write_notifications(spark, spark.createDataFrame(rows, "key string, value string"), workdir + "/sinks")
    sinks = {name: DS.read_notifications(spark, workdir + "/sinks", name).collect() for name in DS.NOTIFICATION_SINKS}
    assert sum(map(len, sinks.values())) == len(rows)
    # a record without a recipient is sent on; only its order id is needed
    assert sorted((r.order_id, r.to) for r in sinks["notifications"]) == [("1", "a@x"), ("2", None)]
    assert {(r.value, r.reason) for r in sinks["dead_letters"]} == {
        ("not json", "malformed_json"), (None, "malformed_json"), ('{"CustomerEmail":"b@x"}', "missing_field:OrderId")}
    assert sorted((str(r.key), r.route) for r in sinks["others"]) == [("InventoryLow", "inventory"), ("None", "unknown"), ("OrderDelivered", "unknown")]


def test_offset_intervals_of_a_gappy_topic_lie_in_many_rows(spark):
    """A gap behind every offset: no row holds more than half a block of intervals."""
    from ledgerline.streaming import reservations as RS
    seen = spark.createDataFrame([], "topic string, partition int, seen array<struct<lo:long,hi:long>>")
    records = spark.range(4000).selectExpr("'t' AS topic", "0 AS partition", "id * 8 AS offset")
    seen = RS.with_offsets(seen, records).cache()
    assert seen.selectExpr("max(size(seen))").first()[0] <= 512 and seen.selectExpr("sum(size(seen))").first()[0] == 4000
    again = spark.range(5000).selectExpr("'t' AS topic", "0 AS partition", "id * 8 AS offset")
    assert RS.unseen(again, seen).count() == 1000
    seen.unpersist()


def test_outcomes_of_a_batch_are_read_back_not_made_again(spark, workdir):
    from ledgerline.streaming import reservations as RS
    ddl = "order_id string, line_no int, product_id string, quantity int, ts timestamp, seq long"
    state = RS.StockState(os.path.join(workdir, "once"))
    state.ensure(spark)
    stock = spark.createDataFrame([("A", 5), ("B", 1)], "product_id string, available int")
    t0 = datetime(2024, 1, 1)
    out = RS.reserve_batch(spark, spark.createDataFrame([("o1", 1, "A", 2, t0, 1), ("o2", 1, "B", 9, t0, 2)], ddl), 0, state, stock)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.order_id: r.reserved for r in out.collect()} == {"o1": True, "o2": False}


def test_delivery_makes_one_pass_and_files_follow_time(spark, workdir):
    """Files in time order by modification time, from one write (there was one a slice, each over the whole log)."""
    from ledgerline.plans import catalog as C
    rows = [(datetime(2024, 1, 1 + (i * 7) % 20), i) for i in range(200)] + [(None, -1)]
    path = os.path.join(workdir, "delivered")
    C.deliver_in_order(spark.createDataFrame(rows, "ts timestamp, i int").repartition(3), "ts", path, 4)
    names = sorted((n for n in os.listdir(path) if n.startswith("part-")), key=lambda n: os.stat(os.path.join(path, n)).st_mtime)
    assert len(names) > 2 and len({n.split("-", 2)[2] for n in names}) == 1   # one job
    spans = [spark.read.parquet(os.path.join(path, n)).agg(F.min("ts"), F.max("ts"), F.count("*")).first() for n in names]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(s[2] for s in spans) == 201


def test_streamed_keys_share_the_calls_of_their_bucket(spark):
    """A trigger's calls and state reads are bounded by the buckets, not one an order or a product."""
    stream = spark.readStream.format("rate").load().selectExpr("cast(value AS string) AS order_id", "value AS seq", "'create' AS command", "timestamp AS ts")
    plan = ST.order_command_stream(stream)._jdf.queryExecution().analyzed().toString()
    assert "bucket" in plan


def test_a_trigger_writes_counters_at_once_and_looks_up_open_pairs_only():
    """2,000 new orders beside 3,000 open ones: no lookup but for the two orders that are closed."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql import Row

    class State(dict):
        def __init__(self, calls):
            self.calls = calls

        def _did(self, what, result=None):
            self.calls.append(what)
            return result

        get = lambda self: self._did("get", self.setdefault(0))                         # noqa: E731
        update = lambda self, value: self._did("update", self.__setitem__(0, value))
        iterator = lambda self: self._did("iterator", iter(self.items()))               # noqa: E731
        getValue = lambda self, key: self._did("lookup", dict.get(self, key))           # noqa: E731
        updateValue = lambda self, key, value: self._did("entry", self.__setitem__(key, value))
        removeKey = lambda self, key: self._did("remove", self.pop(key))                # noqa: E731

    class Handle:
        def __init__(self):
            self.calls, self.states = [], {}

        def state(self, name, *schema):
            return self.states.setdefault(name, State(self.calls))

        getValueState = getMapState = state

    handle, processor = Handle(), ST.StockProcessor()
    processor.init(handle)

    def trigger(*rows):
        at = pd.Timestamp("2024-01-01", tz="UTC")
        columns = zip(*[(p, k, o, q, at, s, 1, hash((p, o)), 0) for s, (p, k, o, q) in enumerate(rows)])
        names = [*ST.COMMAND_COLS, "pair", ST.BUCKET]
        packed, = ST._packed([pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)])
        handle.calls.clear()
        out = list(processor.handleInputRows((0,), iter([Row(data=d) for d in packed.column("data").to_pylist()]), None))
        return [r for d in out for r in next(ST._unpacked([pa.RecordBatch.from_arrays([pa.array([d.data])], ["data"])])).to_pylist()]

    trigger(*[(f"p{i}", "replenish", None, 100) for i in range(300)], *[(f"p{i % 300}", "reserve", f"o{i}", 1) for i in range(3000)])
    assert len(handle.states["reservations"]) == 3000
    out = trigger(("p0", "confirm", "o0", None), ("p1", "release", "o1", None), *[(f"p{i % 300}", "reserve", f"n{i}", 1) for i in range(2000)])
    assert sum(r["applied"] for r in out) == len(out) == 2002
    assert {c: handle.calls.count(c) for c in set(handle.calls) - {"get", "update"}} == {"lookup": 2, "remove": 2, "entry": 2000}
    assert handle.calls.count("get") + handle.calls.count("update") <= 4
    trigger(("p0", "reserve", "o0", 3))
    assert handle.calls.count("lookup") <= 1 and handle.states["reservations"]["+p0", "o0"] == (3,)
    held = {(p[1:], o) for p, o in handle.states["reservations"]}
    known = ST.Known(*handle.states["base"][0], *handle.states["counters"][0][3:])
    assert known.maybe(np.array([hash(pair) for pair in held])).all()
    assert len(known.base) + len(known.opened) - len(known.closed) == len(held) == 4999


def test_a_batch_leaves_no_copy_of_its_records_behind(spark, workdir):
    """What a batch writes to read it again goes with it, and good records are not kept raw; a redelivery changes nothing."""
    from ledgerline.operators import parse as P
    from ledgerline.sources import topics as TP
    from ledgerline.streaming import reservations as RS
    t = Tables(spark, SF)
    records = TP.publish_order_events(D.order_journal(t), D.order_created(t))
    bad = records.limit(1).withColumns({"value": F.lit("{cut"), "offset": F.lit(None).cast("long"), "key": F.lit("bad")})
    records = records.unionByName(records).unionByName(bad)
    once = RS.unseen(records, spark.createDataFrame([], "topic string, partition int, seen array<struct<lo:long,hi:long>>"), P.parse_envelope)
    assert once.count() == records.distinct().count()
    assert once.where("ok")._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(topic") <= 2      # each side of the join
    base = os.path.join(workdir, "lean")
    stock, state = RS.StockState(base), RS.ConsumerState(base)
    stock.ensure(spark)
    state.ensure(spark)
    for n in range(2):
        RS.consume_batch(spark, records, n, stock, state, D.stock_initial(t))
        left = {d: [f for _, _, fs in os.walk(os.path.join(base, d)) for f in fs] for d in ("decoded", "items", "events", "input", "changes")}
        assert not any(left.values()), left
    assert spark.read.parquet(f"{base}/ledger").where("kind = 'reserve'").count() == t.lineitem.count()
    assert [r.value for r in spark.read.parquet(f"{base}/dead_letters").collect()] == ["{cut", "{cut"]
