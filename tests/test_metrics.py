from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import metrics as M
from ledgerline.schemas import NORMALISED_EVENT

ITEM = ("p1", "Widget", 2, Decimal("50.0000"))


def events(spark, rows):
    return spark.createDataFrame(rows, NORMALISED_EVENT)


def test_q1_every_status_counts(spark):
    t = datetime(2024, 1, 1, 10, 5)
    rows = [("o1", "c1", Decimal("100"), [ITEM], "created", t),
            ("o1", "c1", Decimal("100"), [], "confirmed", t.replace(minute=20)),
            ("o1", "c1", Decimal("100"), [], "shipped", t.replace(minute=40))]
    ev = events(spark, rows)
    allr = M.hourly_metrics(ev).collect()
    assert len(allr) == 1 and allr[0].order_count == 3 and allr[0].total_revenue == Decimal("300")
    created = M.hourly_metrics(ev, statuses=["created"]).collect()
    assert created[0].order_count == 1 and created[0].total_revenue == Decimal("100")
    assert created[0].avg_order_value == 100.0
    assert created[0].window_start == datetime(2024, 1, 1, 10) and created[0].window_end == datetime(2024, 1, 1, 11)


def test_window_start_is_hour_truncation_whatever_the_duration(spark):
    ev = events(spark, [("o", "c", Decimal("1"), [], "created", datetime(2024, 1, 1, 10, 59))])
    r = M.hourly_metrics(ev, duration_seconds=7200).collect()[0]
    assert r.window_start == datetime(2024, 1, 1, 10) and r.window_end == datetime(2024, 1, 1, 12)


def test_product_rows_one_aggregate(spark):
    t = datetime(2024, 1, 1, 10, 5)
    ev = events(spark, [("o1", "c", Decimal("100"), [ITEM, ("p2", "B", 1, Decimal("3"))], "created", t),
                        ("o2", "c", Decimal("100"), [ITEM], "created", t)])
    rows = {r.product_id: r for r in M.product_window_rows(M.explode_items(ev)).collect()}
    assert rows["p1"].total_quantity == 4 and rows["p1"].total_revenue == Decimal("200")
    assert rows["p2"].total_quantity == 1 and rows["p2"].total_revenue == Decimal("3")


def test_containment_and_empty_range(spark):
    m = spark.createDataFrame([(datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11), 2, Decimal("10"))],
                              "window_start timestamp, window_end timestamp, order_count long, "
                              "total_revenue decimal(29,4)")
    kept = M.contained(m, datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)).count()
    dropped = M.contained(m, datetime(2024, 1, 1, 10, 30), datetime(2024, 1, 1, 12)).count()
    assert (kept, dropped) == (1, 0)
    empty = M.revenue_summary(m, datetime(2023, 1, 1), datetime(2023, 1, 2)).collect()
    assert len(empty) == 1 and empty[0].total_revenue == 0.0 and empty[0].order_count == 0
    assert empty[0].avg_order_value == 0.0
    full = M.revenue_summary(m, datetime(2024, 1, 1), datetime(2024, 1, 2)).collect()[0]
    assert full.total_revenue == 10.0 and full.order_count == 2 and full.avg_order_value == 5.0


def test_top_products_ties_are_deterministic(spark):
    w0, w1 = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)
    rows = spark.createDataFrame([(w0, w1, "b", 1, Decimal("5")), (w0, w1, "a", 1, Decimal("5")),
                                  (w0, w1, "c", 1, Decimal("9"))],
                                 "window_start timestamp, window_end timestamp, product_id string, "
                                 "total_quantity long, total_revenue decimal(29,4)")
    top = [r.product_id for r in M.top_products(rows, w0, w1, limit=2).collect()]
    assert top == ["c", "a"]


def test_parse_range():
    f, t = M.parse_range("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")
    assert f < t
    with pytest.raises(ValueError, match="from"):
        M.parse_range("nope", "2024-01-02T00:00:00Z")
    with pytest.raises(ValueError, match="to"):
        M.parse_range("2024-01-01T00:00:00Z", "bad")
    with pytest.raises(ValueError):
        M.parse_range("2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z")


def test_batch_partials_sum_to_totals(spark):
    from ledgerline.sources import domain as D
    from ledgerline.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    ev = D.metric_events(t).withColumn("chunk", F.pmod(F.col("order_id").cast("long"), F.lit(5)))
    parts = M.batch_partial_metrics(ev, "chunk").groupBy("window_start").agg(
        F.sum("order_count").alias("n"), F.sum("total_revenue").alias("r"))
    whole = M.hourly_metrics(ev).select("window_start", "order_count", "total_revenue")
    diff = parts.join(whole, "window_start", "full").where(
        (F.col("n") != F.col("order_count")) | (F.col("r") != F.col("total_revenue")) | F.col("n").isNull()
        | F.col("order_count").isNull())
    assert diff.count() == 0


def test_scan_restriction_does_not_change_range_results(spark):
    from ledgerline.plans import catalog as C
    from ledgerline.sources import domain as D
    from ledgerline.sources.tables import Tables
    full = Tables(spark, "/root/testdata/sf0.01")
    cut = C._in_range(full, C.EVENTS_FROM, C.EVENTS_TO)
    a = M.hourly_series(M.hourly_metrics(D.metric_events(full)), C.EVENTS_FROM, C.EVENTS_TO)
    b = M.hourly_series(M.hourly_metrics(D.metric_events(cut)), C.EVENTS_FROM, C.EVENTS_TO)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ta = M.top_products(M.product_window_rows(D.metric_event_items(full)), C.EVENTS_FROM, C.EVENTS_TO)
    tb = M.top_products(M.product_window_rows(D.metric_event_items(cut)), C.EVENTS_FROM, C.EVENTS_TO)
    assert ta.collect() == tb.collect()
