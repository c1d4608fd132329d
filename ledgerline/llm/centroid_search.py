"""Centroid clustering (operator 11) by equal-average equal-variance search.

Lloyd rounds over whole-number vectors (``vectors``), all integers. To find a vector's nearest centroid, the
centroids stand sorted by their components' sum (the mean, times their number). The search starts at the
vector's own sum and goes outward, nearer sum first. Two inequalities bound the squared distance from below:
(difference of sums)**2 / dim, and that plus the square of the difference of deviations (distances from the
own mean). Once the first exceeds the best distance so far, no further centroid can be nearer and the search
ends; where only the second does, that centroid is passed over. What is left gets its exact integer
distance. The bounds are taken a little low, so float rounding never rejects a nearest centroid; ties go to
the smaller number.

Each round is one pass over the table without a shuffle of vectors: a task adds up its own vectors by
centroid, and only those sums (rounds * centroids * components numbers a task) are shuffled. The driver holds
the centroids alone. The last assignment is written before it is totalled.

Rows without a vector, with another number of components, or with a null or non-finite component are left
out. A null id is kept, and comes last where centroids start. Repeated rows each count; where two of the
starting rows share an id, the smaller vector comes first. With fewer vectors than centroids every vector
starts one; an empty table gives an empty table. An empty centroid stays where it is. Other columns
do not matter: the result has its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written
from ledgerline.llm.vectors import rows_of, sound, vector_slices, whole

#: Taken off the bounds against float rounding (relative).
SLACK = 1e-12
FAR = np.int64(2**62)


def deviation(x: np.ndarray) -> np.ndarray:
    """Distance of each row from its own mean, as double."""
    return np.sqrt(((x - x.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)) if x.size else np.zeros(len(x))


@dataclass
class Centroids:
    rows: np.ndarray  # (k, dim), by number

    def __post_init__(self):
        total = self.rows.sum(axis=1)
        self.number = np.lexsort((np.arange(len(total)), total))
        self.sorted, self.sums = self.rows[self.number], total[self.number]
        self.spread = deviation(self.sorted)
        self.compared = 0  # exact distances taken so far

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row."""
        n, k, dim = len(x), len(self.sums), max(1, x.shape[1])
        total, spread = x.sum(axis=1), deviation(x)
        above = np.searchsorted(self.sums, total)
        below = above - 1
        best, which, on = np.full(n, FAR), np.full(n, k), np.arange(n)
        while len(on):
            up, down = above[on], below[on]
            rise = np.where(up < k, self.sums[np.minimum(up, k - 1)] - total[on], FAR)
            fall = np.where(down >= 0, total[on] - self.sums[np.maximum(down, 0)], FAR)
            gap, upward = np.minimum(rise, fall), rise <= fall
            mean = gap.astype(float) ** 2 / dim
            more = np.flatnonzero((gap < FAR) & (mean * (1 - SLACK) <= best[on]))  # else all others are farther by their means
            on, upward, mean = on[more], upward[more], mean[more]
            at = np.where(upward, up[more], down[more])
            above[on[upward]] += 1
            below[on[~upward]] -= 1
            apart = np.abs(spread[on] - self.spread[at]) - SLACK * (spread[on] + self.spread[at])
            near = np.flatnonzero((mean + np.maximum(apart, 0) ** 2) * (1 - SLACK) <= best[on])
            row, at = on[near], at[near]
            self.compared += len(row)
            step = x[row] - self.sorted[at]
            distance, number = np.einsum("ij,ij->i", step, step), self.number[at]
            won = (distance < best[row]) | ((distance == best[row]) & (number < which[row]))
            best[row[won]], which[row[won]] = distance[won], number[won]
        return which, best

    def sha256(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in self.rows.tolist()]


def _sums(batches, dim: int, centroids: Centroids):
    """(cluster, n, sums) of one task's vectors."""
    k = len(centroids.rows)
    count, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for batch in batches:
        for part in vector_slices(batch, "vector"):
            _, x = rows_of(part.column("vector"), dim)
            which, _ = centroids.nearest(x)
            order = np.argsort(which, kind="stable")
            found, first = np.unique(which[order], return_index=True)
            if len(found):
                sums[found] += np.add.reduceat(x[order], first)
                count[found] += np.diff(np.append(first, len(order)))
    some = np.flatnonzero(count)
    if len(some):
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dim), pa.array(sums[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), flat], ["cluster", "n", "sums"])


def _assigned(batches, dim: int, centroids: Centroids):
    for batch in batches:
        for part in vector_slices(batch, "vector"):
            at, x = rows_of(part.column("vector"), dim)
            which, distance = centroids.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(at)), pa.array(which.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])


def start(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors of least sha256 of ``seed`` and id, in that order; ``vectors`` holds (id, vector) of one length."""
    rows = vectors.filter(sound(F.col("vector"))).select(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).alias("h"), "vector") \
        .orderBy(F.asc_nulls_last("h"), "vector").limit(k).collect()  # k rows
    return whole(np.array([r.vector for r in rows], float)) if rows else np.empty((0, 0), np.int64)


def moved(vectors: DataFrame, dim: int, centroids: Centroids) -> Centroids:
    """Each centroid at the floored mean of the vectors nearest to it."""
    sums = vectors.mapInArrow(lambda batches: _sums(batches, dim, centroids), "cluster int, n long, sums array<long>")
    total = sums.select("cluster", "n", F.posexplode("sums").alias("place", "part")).groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    rows = centroids.rows.copy()
    for r in total.collect():  # centroids * components rows
        rows[r.cluster, r.place] = int(r.total) // int(r.n)
    return Centroids(rows)


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: str = "2:", doc_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row (id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) for each usable row of
    ``df``: its nearest centroid after ``rounds`` rounds, the squared distance, that distance summed
    over its cluster and over all, and the centroid itself (its components, and their digest)."""
    spark = df.sparkSession
    vectors = df.select(F.col(doc_id).alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(F.size("vector") == dim)
    rows = start(vectors, k, seed)
    id_type = vectors.schema["id"].dataType.simpleString()
    result = f"id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    if not len(rows):
        return spark.createDataFrame([], result)
    centroids = Centroids(rows)
    for _ in range(rounds):
        centroids = moved(vectors, dim, centroids)
    assigned = written(vectors.mapInArrow(lambda batches: _assigned(batches, dim, centroids), f"id {id_type}, cluster int, distance long"), "centroid-assigned")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    total, names = sum(inertia.values()), centroids.sha256()
    about = spark.createDataFrame([(c, s, total, centroids.rows[c].tolist(), names[c]) for c, s in sorted(inertia.items())],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")  # k rows
