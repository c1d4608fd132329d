"""The split stock fold against the sequential one: random commands, a hot product, refusals, repeated products."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import inventory as I
from ledgerline.operators import split_fold as S

T0 = datetime(2024, 1, 1)
DDL = "product_id string, kind string, order_id string, quantity int, ts timestamp, seq long, line_no int"


def commands(seed, n, stock, products=("A", "A", "B", "C", None), orders=60):
    rng = random.Random(seed)
    rows = [(p, "replenish", None, stock, T0, -1, None) for p in set(products)]
    for i in range(n):
        kind = rng.choices(["reserve", "release", "confirm", "replenish", "audit"], [60, 15, 12, 3, 1])[0]
        oid = f"o{rng.randrange(orders)}" if rng.random() > 0.02 else None
        q = rng.choice([None, 0, -2, *range(1, 9), 40]) if rng.random() < 0.3 else rng.randint(1, 9)
        rows.append((rng.choice(products), kind, oid, q, T0 + timedelta(minutes=rng.randrange(n)), i, rng.choice([None, 1, 2])))
    return rows


def both(spark, rows):
    df = spark.createDataFrame(rows, DDL).repartition(5)
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(key, I.apply_stock_commands(df).collect())), sorted(map(key, S.apply_stock_commands_split(df, 7).collect()))


@pytest.mark.parametrize("seed, n, stock, orders", [(1, 600, 30, 60), (2, 600, 100_000, 60), (3, 500, 200, 5000), (4, 300, 0, 20)])
def test_equals_the_sequential_fold(spark, seed, n, stock, orders):
    one, two = both(spark, commands(seed, n, stock, orders=orders))
    assert one == two


def test_hot_product_lies_in_many_partitions_and_only_doubts_are_folded(spark):
    rng = random.Random(9)
    rows = [("hot", "replenish", None, 4000, T0, -1, None)]
    for i in range(2000):  # scarce only towards the end
        rows.append(("hot", "reserve", f"o{i}", rng.randint(1, 4), T0 + timedelta(minutes=i), i, 1))
        if i % 3 == 0:
            rows.append(("hot", "confirm", f"o{i}", None, T0 + timedelta(minutes=i + 1), i, 1))
    df = spark.createDataFrame(rows, DDL)
    held = S.ranged(df, 8)
    assert held.select("part").distinct().count() == 8 and held.groupBy("part").count().agg(F.max("count")).first()[0] < len(rows) / 4
    one, two = both(spark, rows)
    assert one == two
    refused = [r for r in one if r[1] == "reserve" and r[7] == "False"]
    assert refused  # the proof must fail somewhere, or nothing is tested


def test_empty(spark):
    assert S.apply_stock_commands_split(spark.createDataFrame([], DDL)).collect() == []


def test_whole_rows_are_kept_once(spark):
    """Of the scratch tables of a fold only the sorted rows and the decisions are left; there were four tables of whole rows."""
    import os
    from ledgerline.session import ensure_checkpoint_dir
    folder = os.path.join(ensure_checkpoint_dir(spark), "ledgerline")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    S.apply_stock_commands_split(spark.createDataFrame(commands(5, 300, 50), DDL), 4).collect()
    assert sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before) == ["stock-decided", "stock-ranged"]


def test_sums_of_earlier_partitions_are_as_many_as_partitions(spark):
    rows = S.ranged(spark.createDataFrame(commands(6, 400, 50), DDL).withColumn("m", F.lit(1)), 6, {"m": "so_far"})
    earlier = S._earlier(rows, {"m": F.col("m")})
    assert earlier.count() <= 6
    summed = S._plus_earlier(rows, earlier, {"m": "so_far"}).groupBy("product_id").agg(F.max("so_far").alias("last"), F.count("*").alias("n"))
    assert summed.where("last != n").count() == 0 and summed.count() == 4
