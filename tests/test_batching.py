"""A10: chunks by count or time, cut over range partitions, against a walk over the sorted events."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.batching import cut_batches

AT = datetime(2024, 1, 1)


def walked(rows, size, seconds):
    """offset → offset of its chunk's first event."""
    out, first, n = {}, None, 0
    for at, offset in sorted(rows):
        if first is None or n == size or at >= first[0] + timedelta(seconds=seconds):
            first, n = (at, offset), 0
        out[offset], n = first[1], n + 1
    return out


def chunks(spark, rows, size, seconds, partitions):
    df = spark.createDataFrame([(at, o, f"x{o}") for at, o in rows], "event_time timestamp, offset long, _chunk_of string")
    got = cut_batches(df, size, seconds, num_partitions=partitions)
    assert got.columns == ["event_time", "offset", "_chunk_of", "chunk_start"]
    rows_ = got.collect()
    assert all(r["_chunk_of"] == f"x{r['offset']}" for r in rows_)
    out = {r["offset"]: r["chunk_start"] for r in rows_}
    assert len(out) == len(rows_)
    return out


@pytest.mark.parametrize("size,seconds,partitions", [(200, 60, 5), (3, 7, 8), (1, 5, 3), (50, 1, 6)])
def test_chunks_equal_a_walk(spark, size, seconds, partitions):
    # a dense stretch, an instant that holds a third of the events, a sparse stretch
    rows = [(AT + timedelta(milliseconds=400 * i), i) for i in range(300)]
    rows += [(AT + timedelta(seconds=121), 1000 + i) for i in range(300)]
    rows += [(AT + timedelta(seconds=200 + (i * i) % 977), 5000 - i) for i in range(300)]
    assert chunks(spark, rows, size, seconds, partitions) == walked(rows, size, seconds)


def test_more_partitions_than_a_chunk_has_events(spark):
    rows = [(AT + timedelta(seconds=i), i) for i in range(40)]
    assert chunks(spark, rows, 30, 3600, 16) == walked(rows, 30, 3600)


def test_small_batches_do_not_change_chunks(spark):
    rows = [(AT + timedelta(seconds=(i * 7) % 401), i) for i in range(400)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "9")
    try:
        assert chunks(spark, rows, 25, 30, 3) == walked(rows, 25, 30)
    finally:
        spark.conf.set(key, before)


def test_events_without_time_and_empty_tables(spark):
    rows = [(None, 7), (AT, 1), (AT, 0)]
    assert chunks(spark, rows, 5, 5, 2) == {7: None, 0: 0, 1: 0}
    assert chunks(spark, [], 5, 5, 2) == {}
    with pytest.raises(ValueError):
        cut_batches(spark.range(1).select(F.current_timestamp().alias("event_time"), F.col("id").alias("offset")), 0, 5)
