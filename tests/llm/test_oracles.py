"""Queries with SQL against it, and the registry."""
import __spark_entry__ as entry
from ledgerline.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import compare


def test_sql_gives_the_queries_rows(spark):
    assert compare(spark, "/root/testdata/sf0.001", sorted(ORACLE_SQL), verbose=True) == []


def test_every_operator_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
