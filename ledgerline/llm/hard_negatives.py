"""Hard-negative mining (operator 12) by BOND, the vertical scan of columnar dimensions.

Vectors are whole numbers (``vectors``); a row's score is its integer inner product with the anchor. A task
turns each slice of rows into columns, one a dimension, and keeps every column's least and greatest value.
Every anchor reads the columns in its own order, of descending magnitude of its components, and adds
their parts to its candidates' partial scores. What the dimensions still to come can add lies between the
sums of their least and of their greatest contributions, so each candidate's score is known within an
interval that narrows as it goes. Candidates whose interval can no longer matter leave the
bitmap; those that stay to the last dimension have their exact score.

Two passes over the rows, for a block of anchors at a time:
positives  the best ``positives`` rows of the anchor's label: a candidate leaves once its greatest score is
           below the least score of as many others (or of those found in earlier slices).
negatives  for each of these, the best ``negatives`` rows of other labels in the window of scores
           low * positive <= 100 * score <= high * positive: a candidate leaves the window's bitmap once its
           interval lies outside, or below as many that are surely inside.
A task keeps the best rows found so far by anchor and window, at most ``negatives`` each, and only these are
shuffled. Anchors come to the driver one block (about ``BLOCK``) at a time; each block's result is
written. Nothing is cut: every anchor meets every row, in blocks.

Rows take no part with a null id, label or vector, or a null or non-finite component. Vectors are only
compared with those of as many components. Ties of score go to the smaller id. Rows with the anchor's own id
are never its positives or negatives; other repeated rows each count, and repeated anchor rows (same id,
label and vector) are one anchor. A window of a negative positive score is empty. An empty table, or one
without anchors, gives an empty table. Other columns do not matter: the result has its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import drop, written
from ledgerline.llm.vectors import lengths, rows_of, sound, vector_slices, whole
from ledgerline.session import scratch_path

#: Anchors of a block, and dimensions read between two looks at the bounds.
BLOCK, STEP = 4096, 8
LEAST = -np.int64(2**62)


@dataclass
class Slice:
    """Rows of one length as columns."""

    columns: np.ndarray  # (dim, rows)
    ids: np.ndarray
    labels: np.ndarray  # codes

    def __post_init__(self):
        self.least, self.most = self.columns.min(axis=1, initial=2**62), self.columns.max(axis=1, initial=-2**62)


def scan(rows: Slice, anchor: np.ndarray, live: np.ndarray, narrow) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of the candidates ``live`` that stay. ``narrow(least, most)`` says which do, by the
    bounds of their scores."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * rows.least, anchor * rows.most])[:, order]
    none = np.zeros(1, np.int64)
    # least and greatest sums of what is still to come
    least = np.concatenate((np.cumsum(ends.min(axis=0)[::-1])[::-1], none))
    most = np.concatenate((np.cumsum(ends.max(axis=0)[::-1])[::-1], none))
    partial = np.zeros(len(live), np.int64)
    for t in range(0, len(order), STEP):
        for d in order[t:t + STEP]:
            partial += anchor[d] * rows.columns[d].take(live)
        done = min(t + STEP, len(order))
        stay = np.flatnonzero(narrow(partial + least[done], partial + most[done]))
        if len(stay) < len(live):
            live, partial = live[stay], partial[stay]
        if not len(live):
            break
    return live, partial


def reached(values: np.ndarray, n: int, known: int) -> int:
    """The n-th greatest of ``values``, or ``known`` if that is greater or there are fewer."""
    return max(int(np.partition(values, len(values) - n)[len(values) - n]), known) if len(values) >= n else known


class Best:
    """The best n rows of one anchor or window so far: greatest score first, ties by id."""

    __slots__ = ("scores", "ids", "n")

    def __init__(self, n: int):
        self.scores, self.ids, self.n = np.empty(0, np.int64), np.empty(0, np.int64), n

    def least(self) -> int:
        """The score that a further row has to reach."""
        return int(self.scores[-1]) if len(self.scores) == self.n else int(LEAST)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
            order = np.lexsort((ids, -scores))[:self.n]
            self.scores, self.ids = scores[order], ids[order]


@dataclass
class Anchors:
    ids: np.ndarray
    labels: list
    vectors: list  # whole vectors
    positives: list | None = None  # of each anchor: [(id, score)], best first

    @classmethod
    def of(cls, rows: pa.Table) -> "Anchors":
        return cls(rows.column("id").to_numpy(), rows.column("label").to_pylist(), [whole(np.array([v], float).reshape(1, -1))[0] for v in rows.column("vector").to_pylist()])


def _slices(batches, anchors: Anchors):
    """(slice of rows, numbers of the anchors as long, their labels' codes)."""
    by_length: dict[int, list[int]] = {}
    for a, vector in enumerate(anchors.vectors):
        by_length.setdefault(len(vector), []).append(a)
    for batch in batches:
        for part in vector_slices(batch, "vector"):
            encoded = part.column("label").dictionary_encode()
            code = {label: k for k, label in enumerate(encoded.dictionary.to_pylist())}
            codes, ids = encoded.indices.to_numpy(zero_copy_only=False), part.column("id").to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths(part.column("vector"))).tolist():
                if dim in by_length:
                    at, x = rows_of(part.column("vector"), dim)
                    rows = Slice(np.ascontiguousarray(x.T), ids[at], codes[at])
                    yield rows, [(a, code.get(anchors.labels[a], -1)) for a in by_length[dim]]


def find_positives(batches, anchors: Anchors, n: int):
    """(anchor, id, score): a task's best n rows of each anchor's label."""
    best = [Best(n) for _ in anchors.ids]
    for rows, of in _slices(batches, anchors):
        for a, label in of:
            mine = best[a]

            def narrow(least, most, mine=mine):
                return most >= reached(least, n, mine.least())

            live = np.flatnonzero((rows.labels == label) & (rows.ids != anchors.ids[a]))
            if len(live):
                live, score = scan(rows, anchors.vectors[a], live, narrow)
                mine.take(score, rows.ids[live])
    yield _found(["anchor", "id", "score"], [(a, i, s) for a, b in enumerate(best) for i, s in zip(b.ids.tolist(), b.scores.tolist())], "iqq")


def find_negatives(batches, anchors: Anchors, n: int, low: int, high: int):
    """(anchor, place, id, score): a task's best n rows of other labels in the window of each anchor's each positive."""
    windows = [[(-(-low * s // 100), high * s // 100) for _, s in found] for found in anchors.positives]
    best = [[Best(n) for _ in w] for w in windows]
    for rows, of in _slices(batches, anchors):
        for a, label in of:
            mine = [(b, lo, hi) for b, (lo, hi) in zip(best[a], windows[a]) if lo <= hi]

            def narrow(least, most, mine=mine):
                stay = np.zeros(len(least), bool)
                for b, lo, hi in mine:
                    inside = (least >= lo) & (most <= hi)
                    stay |= (most >= max(lo, reached(least[inside], n, b.least()))) & (least <= hi)
                return stay

            live = np.flatnonzero((rows.labels != label) & (rows.ids != anchors.ids[a])) if mine else ()
            if len(live):
                live, score = scan(rows, anchors.vectors[a], live, narrow)
                for b, lo, hi in mine:
                    inside = (score >= max(lo, b.least())) & (score <= hi)
                    b.take(score[inside], rows.ids[live[inside]])
    yield _found(["anchor", "place", "id", "score"], [(a, p, i, s) for a, all_ in enumerate(best) for p, b in enumerate(all_) for i, s in zip(b.ids.tolist(), b.scores.tolist())], "iiqq")


def _found(names: list[str], rows: list[tuple], kinds: str) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.RecordBatch.from_arrays([pa.array(table[:, k].astype(np.int32 if kind == "i" else np.int64)) for k, kind in enumerate(kinds)], names)


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The best n rows, over all tasks, of each key, with their ``rank``."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= n)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(df: DataFrame, anchor: Column, doc_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block: int = BLOCK) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of ``df`` where
    ``anchor`` (a condition on the columns of ``df``) holds, and each of its positives, its hard negatives."""
    spark = df.sparkSession
    named = [F.col(doc_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector")]
    rows = df.select(*named).filter("id is not null and label is not null and vector is not null")
    chosen = written(df.filter(anchor).select(*named).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & sound(F.col("vector"))).distinct(), "negative-anchors")
    blocks = -(-chosen.count() // block)
    dealt = written(chosen.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(max(1, blocks))).cast("int")), "negative-blocks", by="block")
    drop(spark, chosen)
    path = scratch_path(spark, "negative-found")
    for k in range(blocks):
        anchors = Anchors.of(dealt.filter(F.col("block") == k).orderBy("id", "label", "vector").toArrow())  # about ``block`` rows
        if not len(anchors.ids):
            continue
        found = rows.mapInArrow(lambda batches, a=anchors: find_positives(batches, a, positives), "anchor int, id long, score long")
        anchors.positives = [[] for _ in anchors.ids]
        for r in _first(found, ["anchor"], positives).orderBy("anchor", "rank").toArrow().to_pylist():  # at most ``positives`` an anchor
            anchors.positives[r["anchor"]].append((r["id"], r["score"]))
        found = rows.mapInArrow(lambda batches, a=anchors: find_negatives(batches, a, negatives, low, high), "anchor int, place int, id long, score long")
        about = pa.table({"anchor": pa.array([a for a, p in enumerate(anchors.positives) for _ in p], pa.int32()), "place": pa.array([k for p in anchors.positives for k in range(len(p))], pa.int32()),
                          "anchor_id": pa.array([int(anchors.ids[a]) for a, p in enumerate(anchors.positives) for _ in p], pa.int64()),
                          "positive_id": pa.array([i for p in anchors.positives for i, _ in p], pa.int64()), "positive_score": pa.array([s for p in anchors.positives for _, s in p], pa.int64())})
        _first(found, ["anchor", "place"], negatives).join(F.broadcast(spark.createDataFrame(about)), ["anchor", "place"]) \
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")) \
            .write.mode("overwrite").parquet(f"{path}/block={k}")
    drop(spark, dealt)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT + ", block int").parquet(path).drop("block")
