"""A10: cutting one ordered sequence of events into chunks by count or time.

A chunk starts with its first event and takes the events that follow, up to
``size`` of them, while their time is before the first one's plus the flush
interval; the next event starts the next chunk. Where a chunk starts depends
on all chunks before it, yet the sequence is cut in parallel:

1. the events are sorted by (time, offset) over range partitions and written;
2. whatever chunk is open where a partition begins, the first chunk started
   inside starts with one of its first ``size`` events (or none does). For each of
   these the partition finds the chunk open at its end, by pointer
   doubling over "the chunk that starts here is followed by the one that
   starts there", batch by batch;
3. these tables, at most ``size`` entries a partition, are chained from
   partition to partition (the driver reads one partition's at a time);
4. each partition, told the chunk open where it begins, marks its events.

A task holds one Arrow batch and ``size`` states; one instant with a third of
all events is split by offset like any other. Events without a time have no
chunk (``chunk_start`` null); ``offset`` must tell events apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

_ENTRY_DDL = "part int, events long, head array<long>, start array<long>, chunk array<long>, count array<long>"


def followers(times: np.ndarray, size: int, micros: int) -> np.ndarray:
    """For each event: where the next chunk starts if one starts here (the length, if not in this batch)."""
    n = len(times)
    return np.minimum(np.minimum(np.arange(n) + size, np.searchsorted(times, times + micros, "left")), n)


def last_starts(follow: np.ndarray) -> np.ndarray:
    """For each event: the start of the chunk that is open at the end if a chunk starts here (pointer doubling)."""
    n = len(follow)
    jump = np.where(follow < n, follow, np.arange(n))
    while not np.array_equal(further := jump[jump], jump):
        jump = further
    return jump


def _first_free(times, start, count, size: int, micros: int) -> np.ndarray:
    """Where the chunks open before these events (their first time, their events so far) end."""
    room = np.searchsorted(times, start + micros, "left")
    return np.maximum(np.minimum(room, size - count), 0)


class _Ends:
    """Step 2 for the rows of whole partitions, sorted by (part, pos): one table each."""

    def __init__(self, size: int, micros: int):
        self.size, self.micros = size, micros

    def _begin(self, part: int) -> None:
        self.part, self.events, self.head = part, 0, []
        self.start, self.chunk, self.count = (np.empty(0, np.int64) for _ in range(3))

    def _take(self, times: np.ndarray, offsets: np.ndarray) -> None:
        last, n = last_starts(followers(times, self.size, self.micros)), len(times)
        free = _first_free(times, self.start, self.count, self.size, self.micros)
        inside = free < n
        at = last[np.where(inside, free, 0)]
        start, chunk = np.where(inside, times[at], self.start), np.where(inside, offsets[at], self.chunk)
        count = np.where(inside, n - at, self.count + n)
        new = last[:max(self.size - self.events, 0)]          # events that may start the partition's first chunk
        self.head.extend(times[:len(new)].tolist())
        self.start, self.chunk = np.append(start, times[new]), np.append(chunk, offsets[new])
        self.count = np.append(count, n - new)
        self.events += n

    def _table(self) -> pa.RecordBatch:
        lists = [pa.array([v], pa.list_(pa.int64())) for v in (self.head, self.start.tolist(), self.chunk.tolist(), self.count.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([self.part], pa.int32()), pa.array([self.events], pa.int64()), *lists],
                                          ["part", "events", "head", "start", "chunk", "count"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.part = None
        for batch in batches:
            for part, rows in _by_part(batch):
                if part != self.part:
                    if self.part is not None:
                        yield self._table()
                    self._begin(part)
                self._take(_ints(rows, "_time"), _ints(rows, "_offset"))
        if self.part is not None:
            yield self._table()


class _Marks:
    """Step 4: the events of whole partitions with the offset their chunk starts at."""

    def __init__(self, size: int, micros: int, columns: list[str]):
        self.size, self.micros, self.columns = size, micros, columns

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for p, rows in _by_part(batch):
                times, offsets = _ints(rows, "_time"), _ints(rows, "_offset")
                if p != part:                                  # the chunk open where the partition begins
                    part, start, chunk, count = p, *(int(_ints(rows, c)[0]) for c in ("_start", "_chunk", "_count"))
                follow, n = followers(times, self.size, self.micros), len(times)
                at = int(_first_free(times, np.array([start]), np.array([count]), self.size, self.micros)[0]) if count else 0
                chunks = np.full(n, chunk, np.int64)
                count += min(at, n)
                while at < n:
                    start, chunk, end = int(times[at]), int(offsets[at]), int(follow[at])
                    chunks[at:end] = chunk
                    at, count = end, end - at
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in self.columns), pa.array(chunks)], [*self.columns, "chunk_start"])


def _ints(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _by_part(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    parts = _ints(batch, "_part")
    if not len(parts):
        return
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield int(parts[lo]), batch.slice(lo, hi - lo)


def _chain(ends: DataFrame, size: int, micros: int) -> list[tuple[int, int, int, int]]:
    """Step 3: (part, first time, first offset, events so far) of the chunk open where each partition begins."""
    entries, start, chunk, count = [], 0, 0, 0
    for row in ends.orderBy("part").toLocalIterator():
        entries.append((row["part"], start, chunk, count))
        head = np.array(row["head"], np.int64)
        free = int(_first_free(head, np.array([start]), np.array([count]), size, micros)[0]) if count else 0
        if free < len(head):
            start, chunk, count = row["start"][free], row["chunk"][free], row["count"][free]
        else:                                                  # all of a short partition joins the open chunk
            count += row["events"]
    return entries


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_batches(events: DataFrame, size: int, seconds: int, time: str = "event_time", offset: str = "offset",
                num_partitions: int | None = None) -> DataFrame:
    """``events`` with ``chunk_start``, the offset of the first event of its chunk (at most ``size`` events, ``seconds`` long)."""
    if size < 1 or seconds <= 0:
        raise ValueError("size and seconds must be positive")
    spark, micros, columns = events.sparkSession, seconds * 1_000_000, events.columns
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    timed = events.where(F.col(time).isNotNull())
    order = [F.unix_micros(F.col(time).cast("timestamp")).alias("_time"), F.col(offset).cast("long").alias("_offset")]
    ranged = timed.select("*", *order).repartitionByRange(n, "_time", "_offset").sortWithinPartitions("_time", "_offset")
    ranged = _kept(spark, ranged.withColumn("_part", F.spark_partition_id()), "chunk-ranges")

    def by_part(df):
        return df.repartition(n, "_part").sortWithinPartitions("_part", "_time", "_offset")

    ends = _kept(spark, by_part(ranged.select("_part", "_time", "_offset")).mapInArrow(_Ends(size, micros), _ENTRY_DDL), "chunk-ends")
    entries = spark.createDataFrame(_chain(ends, size, micros), "_part int, _start long, _chunk long, _count long")
    out = events.select("*", F.lit(None).cast("long").alias("chunk_start")).schema
    marked = by_part(ranged.join(entries, "_part")).mapInArrow(_Marks(size, micros, columns), out)
    return marked.unionByName(events.where(F.col(time).isNull()).withColumn("chunk_start", F.lit(None).cast("long")))
