"""Plan guards: properties every registered query's physical plan must keep at scale."""
import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# queries that run a stream or write a record table when called (checked by their own tests)
WRITES = ("_stream", "s1_", "s2_", "s3_")
FOLDS = ("k2_", "k7_", "k8_", "k9_release", "k10_", "s8_")


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in entry.queries().items():
        if any(w in name for w in WRITES) or name == "pipeline" or re.match(r"op\d+_", name):
            continue
        out[name] = plan_text(fn(spark, SF))
    return out


def test_no_cross_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items() if re.search(r"CartesianProduct|BroadcastNestedLoopJoin", p)]
    assert bad == []


def test_python_only_in_the_folds(plans):
    for name, p in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython", p), name      # no per-row / scalar UDFs
        if re.search(r"MapInPandas|FlatMapGroupsInPandas", p):
            assert name.startswith(FOLDS), name


def test_no_global_sort_or_single_partition_window(plans):
    for name, p in plans.items():
        assert "SinglePartition" not in p or name.startswith(("t1_", "t2_", "t3_", "a6_")), name
        for m in re.finditer(r"\(\d+\) Window\n.*?Arguments: (.*)", p):
            assert "[]" not in m.group(1).split("]", 1)[0] + "]", name


def test_fold_shuffles_once_on_its_key(spark):
    from ledgerline.operators import inventory as I
    from ledgerline.sources.tables import Tables
    from ledgerline.sources import domain as D
    cmds = spark.read.parquet(Tables(spark, SF).path("part")).selectExpr(
        "CAST(p_partkey AS STRING) AS product_id", "'replenish' AS kind", "CAST(NULL AS STRING) AS order_id",
        "p_size AS quantity", "CAST('1990-01-01' AS TIMESTAMP) AS ts", "CAST(-1 AS BIGINT) AS seq")
    p = plan_text(I.apply_stock_commands(cmds))
    tree = p.split("\n\n")[0]
    assert tree.count("Exchange") == 1                          # one shuffle: the repartition on the key
    assert re.search(r"Arguments: hashpartitioning\(product_id", p)
    assert "MapInPandas" in tree and "Sort" in tree              # sorted within partitions, streamed
    assert D is not None


def test_range_query_pushes_event_time_to_the_scan(plans):
    p = plans["t2_hourly_series"]
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,.*LessThan\(ts,", p)
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in p


def test_a_page_reads_the_lines_of_its_orders_only(spark, plans):
    from ledgerline.operators import orders as O
    from ledgerline.plans import catalog as C
    from ledgerline.sources.tables import Tables
    t = Tables(spark, SF)
    narrow = plan_text(O.list_orders(C._order_state(t), status=C.LIST_STATUS))
    assert "TakeOrderedAndProject" in narrow
    lines = re.findall(r"ReadSchema: struct<(l_[^>]*)>", narrow)
    assert lines and all(set(re.findall(r"(\w+):", s)) <= {"l_orderkey", "l_partkey"} for s in lines), lines
    p = plans["t3_list_orders"]
    assert len(re.findall(r"Location.*lineitem", p)) == len(re.findall(r"PushedFilters: \[.*In\(l_orderkey|PushedFilters: \[.*l_orderkey,\[", p)) > 0


def test_point_lookup_pushes_the_key_to_the_scans(plans):
    p = plans["p15_find_order"]
    assert re.search(r"PushedFilters: \[.*EqualTo\(o_orderkey,1000\)", p)
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_orderkey,1000\)", p)
