"""Operator 11 against plain Python rounds, with odd rows, ties and empty tables."""
import hashlib
import math
import random

import numpy as np
import pytest

from ledgerline.llm import centroid_search as C

SCHEMA = "vec_id long, embedding array<float>, cluster string, id int"


def plain(rows, k, rounds, dim):
    """{(vec_id, vector): [(cluster, distance)]}, inertias by cluster, centroids."""
    kept = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = tuple(sum(xs) // len(g) for xs in zip(*g))
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return out, inertia, centroids


def check(spark, rows, k, rounds, dim):
    df = spark.createDataFrame([(i, v, "old", 7) for i, v in rows], SCHEMA).repartition(3)
    got = C.cluster(df, k=k, rounds=rounds, dim=dim).collect()
    out, inertia, centroids = plain(rows, k, rounds, dim)
    assert sorted((str(r.id), r.cluster, r.distance) for r in got) == sorted((str(i), c, d) for i, c, d in out)
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        assert tuple(r.centroid) == centroids[r.cluster]
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def odd_rows(dim=4):
    rng = random.Random(11)
    rows = [(i, [rng.choice([-1, 0, 1]) * rng.random() for _ in range(dim)]) for i in range(150)]
    rows += [(i, [0.5] * dim) for i in range(200, 260)]  # a vector in many rows
    rows += [(7, [0.25] * dim), (7, [0.25] * dim), (7, [-2.0] * dim), (None, [0.125] * dim)]
    rows += [(900, None), (901, []), (902, [1.0] * (dim + 1)), (903, [1.0, None] + [0.0] * (dim - 2)), (904, [float("nan")] * dim), (905, [float("-inf")] * dim)]
    return rows


def test_equals_plain_rounds(spark):
    check(spark, odd_rows(), k=9, rounds=3, dim=4)


def test_fewer_vectors_than_centroids_and_ties(spark):
    check(spark, [(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [3.0, 3.0]), (4, [2.0, 2.0])], k=10, rounds=2, dim=2)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = C.cluster(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA), dim=2)
        assert df.collect() == [] and df.columns[:3] == ["id", "cluster", "distance"]


def test_components_out_of_range_raise(spark):
    with pytest.raises(Exception, match="may hold up to"):
        check(spark, [(1, [1e30, 0.0])], k=1, rounds=1, dim=2)


def test_search_is_exact_and_rejects_most_centroids():
    rng = np.random.default_rng(5)
    centres = rng.integers(-500, 500, (60, 64)) + rng.integers(-400, 400, (60, 1))
    x = (centres[rng.integers(0, 60, 3000)] + rng.integers(-20, 20, (3000, 64))).astype(np.int64)
    c = C.Centroids(centres.astype(np.int64))
    which, distance = c.nearest(x)
    every = ((x[:, None, :] - c.rows[None]) ** 2).sum(axis=2)
    assert (which == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert c.compared < 0.25 * every.size


def test_search_is_exact_at_the_limit():
    top = C.rows_of.__globals__["limit"](8)
    rng = np.random.default_rng(6)
    x = rng.choice([-top, -top + 1, top - 1, top], (500, 8)).astype(np.int64)
    c = C.Centroids(x[:40])
    every = ((x[:, None, :].astype(object) - c.rows[None].astype(object)) ** 2).sum(axis=2)
    which, distance = c.nearest(x)
    assert (which == np.array([int(np.argmin(r)) for r in every])).all() and distance.tolist() == [int(min(r)) for r in every]
