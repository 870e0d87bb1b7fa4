"""Arithmetic on vectors held as arrays.

Sums over many long vectors run on Arrow batches with NumPy; single products stay native.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is missing or has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def _sums(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the lists that hold any vector, and the sum of the vectors of each."""
    counts = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    rows = np.flatnonzero(counts)
    if not len(rows):
        return rows, np.zeros((0, 0))
    matrix = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    borders = np.concatenate([[0], np.cumsum(counts)])[rows]
    return rows, np.add.reduceat(matrix, borders, axis=0)


@F.arrow_udf(T.DoubleType())
def length_of_sum(vectors: pa.Array) -> pa.Array:
    """Length of the element-wise sum of an array of vectors; null for no vectors."""
    rows, sums = _sums(vectors)
    out = np.full(len(vectors), np.nan)
    out[rows] = np.sqrt(np.einsum("ij,ij->i", sums, sums)) if len(rows) else 0.0
    return pa.array(out, from_pandas=True)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def mean_of(vectors: pa.Array) -> pa.Array:
    """Element-wise mean of an array of vectors; null for no vectors."""
    rows, sums = _sums(vectors)
    counts = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    width = sums.shape[1]
    filled = counts > 0
    borders = np.concatenate([[0], np.cumsum(np.where(filled, width, 0))]).astype(np.int32)
    values = (sums / counts[rows][:, None]).ravel() if len(rows) else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(values), mask=pa.array(~filled))
