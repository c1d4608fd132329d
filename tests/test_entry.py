"""Driver contract: entry smoke, registry consistency and every query against its oracle."""
import re

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"window_start", "window_end", "order_count", "total_revenue", "avg_order_value"} <= set(df.columns)


def own(names):
    """The queries of the event analytics; those of the training-data operators have their own tests."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_registry_consistency():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(own(qs)) >= 60


def test_all_queries_match_oracle_small(spark):
    from tools.oracle_check import compare
    failed = compare(spark, "/root/testdata/sf0.001", sorted(own(entry.queries())), verbose=False)
    assert failed == []


def test_every_query_has_an_oracle():
    assert own(entry.queries()) == own(entry.oracle_sql())
