"""Logs with positions, resumed runs, gaps and repeats against a walk over the log."""
import os

from ledgerline.sources import journal as JN

DDL = "order_id string, seq long, n int"


def walked(log):
    high, out = {}, set()
    for position, (oid, seq) in enumerate(log):
        seen = high.get(oid, -1)
        if seq is None:
            out.add((oid, position, None, "unnumbered", None, None))
            continue
        if seq <= seen:
            out.add((oid, position, seq, "repeat", None, None))
        elif seq > seen + 1:
            out.add((oid, position, seq, "gap", seen + 1, seq - 1))
        high[oid] = max(seen, seq)
    return out


def test_a_resumed_audit_equals_a_walk(spark, workdir):
    # one aggregate holds a third of the log; lost, repeated, late and unnumbered events, some without an aggregate
    log = [("hot", i // 3) if i % 3 == 0 else (f"o{i % 7}", i // 7) for i in range(240)]
    log[30], log[90], log[120], log[121], log[150] = ("hot", 2), ("hot", 50), (None, 0), (None, 3), ("o1", None)
    path, base = os.path.join(workdir, "log"), os.path.join(workdir, "consumer")
    JN.write_journal(spark.createDataFrame([(o, s, n) for n, (o, s) in enumerate(log)], DDL), path, "n")
    assert all(r["n"] == r["position"] for r in JN.read_journal(spark, path).collect())
    consumer = JN.JournalConsumer(spark, path, base)
    assert consumer.position() is None and consumer.findings().count() == 0
    read = [r["position"] for end in (80, 161, None) for r in JN.JournalConsumer(spark, path, base).run(end).collect()]
    assert sorted(read) == list(range(240)) and consumer.position() == 239
    assert {tuple(r) for r in consumer.findings().collect()} == walked(log)
    assert consumer.findings().count() == len(walked(log))
    assert consumer.run() is None                              # nothing new


def test_a_run_that_was_lost_is_done_anew(spark, workdir):
    log = [("a", 0), ("b", 0), ("a", 2), ("b", 0), ("a", 3), ("b", 1)]
    path, base = os.path.join(workdir, "log"), os.path.join(workdir, "consumer")
    JN.write_journal(spark.createDataFrame([(o, s, n) for n, (o, s) in enumerate(log)], DDL), path, "n")
    first = JN.JournalConsumer(spark, path, base)
    first.run(2)
    stored = first.position
    first.position = lambda: None                              # as if the position had not been written
    first.run(2)
    first.position = stored
    first.run()
    assert {tuple(r) for r in first.findings().collect()} == walked(log)


def test_an_empty_log(spark, workdir):
    path = os.path.join(workdir, "log")
    JN.write_journal(spark.createDataFrame([], DDL), path, "n")
    consumer = JN.JournalConsumer(spark, path, os.path.join(workdir, "consumer"))
    assert consumer.run() is None and consumer.findings().count() == 0
