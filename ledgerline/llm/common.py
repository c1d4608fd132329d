"""Helpers shared by the training-data operators: word ids from UTF-8 bytes,
batch slicing, shared scratch tables and size-checked broadcasts."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: Text bytes a Python worker handles at a time. A longer text is one slice of its own.
SLICE_BYTES = 2 << 20
#: Rows of a Parquet reader's column batch. A batch of texts is one array that doubles as it grows; of Spark's 4,096 rows, with
#: texts of some kilobytes, that takes tens of MB in a piece, which the heap grows for.
READ_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_reads(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder (in folders ``by`` a column) and read back: later stages start from
    files every executor can read, so a lost executor costs one stage at most."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for t in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """``drop``, and let Spark's cleaner remove the shuffle files of finished stages too (it
    acts when the driver's JVM collects): for use after stages that moved whole tables."""
    drop(spark, *tables)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_reads(spark: SparkSession) -> None:
    """Column batches of at most ``READ_ROWS`` rows from Parquet, so that a batch of long texts is no huge object."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(key)) > READ_ROWS:
        spark.conf.set(key, str(READ_ROWS))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows to Python, so that a batch of long texts fits; small reads too."""
    small_reads(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Row slices of ``batch`` whose ``column`` holds about ``limit`` bytes."""
    n = batch.num_rows
    if not n:
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    cut = np.searchsorted(size, np.arange(limit, size[-1] + limit, limit))
    start = 0
    for stop in np.unique(np.append(np.minimum(cut + 1, n), n)):
        if stop > start:
            yield batch.slice(start, stop - start)
            start = int(stop)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after another, and the texts' bounds (nulls are empty)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


# -- hashes -------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit name of an ordered pair of 64-bit names."""
    return mix(mix(a + np.uint64(0x9E3779B97F4A7C15 + salt)) * np.uint64(3) + b)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = 1 << 16
_POW = np.ones(_STEP, np.uint64)
with np.errstate(over="ignore"):
    _POW[1:] = np.cumprod(np.full(_STEP - 1, _BASE, np.uint64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range (words): a polynomial over random byte
    values, summed with one prefix sum, so equal words hash alike wherever they stand.
    A range's value is taken at its own start, through powers of its byte offsets."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = stops - starts
    longest = int(lengths.max())
    if longest <= 64:
        out = np.zeros(len(starts), np.uint64)
        value = _BYTE[data]
        order = np.argsort((64 - lengths).astype(np.uint8), kind="stable")  # long words first
        at = starts[order]
        longer = len(starts) - np.cumsum(np.bincount(lengths, minlength=longest + 1))
        for j in range(longest):
            k = longer[j]  # words longer than j
            out[:k] = out[:k] * _BASE + value[at[:k] + j]
        done = np.empty_like(out)
        done[order] = out
        return mix(done ^ (lengths.astype(np.uint64) << np.uint64(40)))
    out = np.empty(len(starts), np.uint64)
    short = lengths <= 64
    out[short] = word_hashes(data, starts[short], stops[short])
    for i in np.nonzero(~short)[0]:
        h = 0
        part = _BYTE[data[starts[i]:stops[i]]]
        for k in range(0, len(part), _STEP):
            block = part[k:k + _STEP]
            h = (h * int(_POW[len(block) - 1]) * int(_BASE) + int((block * _POW[:len(block)][::-1]).sum(dtype=np.uint64))) & (2**64 - 1)
        out[i] = mix(np.array([h ^ ((int(lengths[i]) << 40) & (2**64 - 1))], np.uint64))[0]
    return out


def runs_of(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flag.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def words_of(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs of bytes with ``is_word``) of each text: byte starts,
    stops, and the index of the first word of each text (one entry more than texts)."""
    flag = np.zeros(len(data) + len(bounds) - 1, bool)  # a gap after each text keeps neighbours apart
    shift = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    flag[np.arange(len(data)) + shift] = is_word[data]
    starts, stops = runs_of(flag)
    text = np.searchsorted(bounds[1:] + np.arange(len(bounds) - 1), starts, side="left")
    first = np.searchsorted(text, np.arange(len(bounds)))
    return starts - text, stops - text, first


def sha(column) -> F.Column:
    return F.sha2(column, 256)
