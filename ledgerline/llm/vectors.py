"""Whole-number vectors for the operators on embeddings (11 and 12).

A component x becomes floor(256 * x), with x as a double. Sums, products and squared distances are then
exact 64-bit integers: a component outside the range in which they fit raises an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
#: Vector bytes a Python worker handles at a time; a longer vector is a slice of its own.
VECTOR_BYTES = 8 << 20


def limit(dim: int) -> int:
    """Of ``dim`` components up to this in absolute value, squared distances stay below 2**62."""
    return math.isqrt(2**62 // max(dim, 1)) // 2


def sound(vector: Column) -> Column:
    """Whether a double array is there and has neither null nor non-finite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def whole(values: np.ndarray) -> np.ndarray:
    """Rows of components, scaled and floored."""
    scaled = np.floor(values * SCALE)
    most = np.abs(scaled).max(initial=0)
    if most > limit(values.shape[1]):
        raise ValueError(f"component {most:.0f} after scaling; vectors of {values.shape[1]} components may hold up to {limit(values.shape[1])}")
    return scaled.astype(np.int64)


def lengths(column: pa.ListArray) -> np.ndarray:
    """Components of each vector; -1 for a null one or one with a null or non-finite component."""
    bounds = column.offsets.to_numpy()
    broken = np.concatenate(([0], np.cumsum(~np.isfinite(column.values.to_numpy(zero_copy_only=False)))))  # a null value reads as nan
    usable = (broken[bounds[1:]] == broken[bounds[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(usable, np.diff(bounds), -1)


def rows_of(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, whole vectors) of the usable vectors with ``dim`` components."""
    at = np.flatnonzero(lengths(column) == dim)
    first = column.offsets.to_numpy()[at]
    values = column.values.to_numpy(zero_copy_only=False)
    return at, whole(values[first[:, None] + np.arange(dim)])


def vector_slices(batch: pa.RecordBatch, column: str):
    """Row slices of ``batch`` that hold about ``VECTOR_BYTES`` of vectors."""
    ends = batch.column(column).offsets.to_numpy() * 8
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + VECTOR_BYTES, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
