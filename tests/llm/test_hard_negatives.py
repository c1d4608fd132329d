"""Operator 12 against all products in plain Python, with odd rows, ties, repeated rows and empty tables."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, anchor_id int"


def plain(rows, positives=5, negatives=5, low=80, high=100):
    kept = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, ca in {(i, tuple(v), c): (i, v, c) for i, v, c in kept if i % 100 == 0}.values():
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, c) for i, v, c in kept if i != a and len(v) == len(va))
        for s, i, _ in [r for r in scored if r[2] == ca][:positives]:
            found = [r for r in scored if r[2] != ca and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, i, k, r[1], -s, -r[0]) for k, r in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "old", 3) for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 100 == 0, **options).collect())


def odd_rows(n=900, dim=12, labels=3):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in base[i % 6]], rng.randrange(labels)) for i in range(n)]
    rows += [(i, [1.0] * dim, i % 2) for i in range(1000, 1150)]  # one vector in many rows, 1000 and 1100 anchors: ties by id
    rows += [(300, [0.5] * dim, 1)] * 2 + [(300, [0.5] * dim, 2), (41, [1.5] * dim, 1), (41, [1.5] * dim, 1)]
    rows += [(None, [1.0] * dim, 1), (2000, None, 1), (2100, [1.0] * dim, None), (2200, [1.0, None] + [1.0] * (dim - 2), 1),
             (2300, [float("nan")] * dim, 1), (2400, [float("inf")] * dim, 1), (2500, [], 1), (2501, [], 1), (2502, [], 2), (2600, [2.0, 1.0], 0), (2601, [2.0, 1.5], 0), (2602, [2.0, 1.2], 1), (2603, [1.0] * 5000, 1)]
    return rows


def test_equals_all_products(spark):
    rows = odd_rows()
    expected = plain(rows)
    assert len(expected) > 100
    assert mined(spark, rows) == expected
    assert mined(spark, rows, block=3) == expected  # anchors dealt over several blocks


def test_other_windows(spark):
    rows = odd_rows(400)
    assert mined(spark, rows, positives=3, negatives=2, low=50, high=90) == plain(rows, 3, 2, 50, 90)


def test_no_anchors_and_no_rows(spark):
    for rows in ([], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, None, 1)]):
        df = H.mine(spark.createDataFrame([(*r, "old", 3) for r in rows], SCHEMA), F.col("vec_id") % 100 == 0)
        assert df.collect() == [] and df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_drop_candidates_before_the_last_dimension():
    rng = np.random.default_rng(1)
    columns = rng.integers(-50, 50, (64, 4000))
    columns[:8] = rng.integers(-2000, 2000, (8, 4000))
    rows = H.Slice(columns.astype(np.int64), np.arange(4000), np.zeros(4000, int))
    anchor = columns[:, 0].astype(np.int64)
    sizes = []

    def narrow(least, most):
        stay = most >= H.reached(least, 5, int(H.LEAST))
        sizes.append(int(stay.sum()))
        return stay

    live, score = H.scan(rows, anchor, np.arange(4000), narrow)
    every = anchor @ columns
    assert sizes[0] < 400 and set(np.argsort(-every)[:5]) <= set(live.tolist()) and (score == every[live]).all()
