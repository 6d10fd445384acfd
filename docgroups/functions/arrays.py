"""Vectors as ``ARRAY<DOUBLE>`` columns, and as numpy blocks inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def unit(vec: Column) -> Column:
    """Scale to length one; a zero vector stays as it is."""
    length = norm(vec)
    return F.when(length > 0, F.transform(vec, lambda x: x / length)).otherwise(vec)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vector_sum(vec: Column) -> Column:
    """Element-wise sum of arrays as an aggregate, combined map-side."""
    return vector_to_array(Summarizer.sum(array_to_vector(vec)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equal-length lists as a 2-D array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def lists(values: np.ndarray) -> pa.Array:
    """A 2-D array as a column of lists."""
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int64) * width)
    return pa.LargeListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel())).cast(
        pa.list_(pa.from_numpy_dtype(values.dtype))
    )


def unit_matrix(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)
