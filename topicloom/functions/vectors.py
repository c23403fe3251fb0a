"""Vector arithmetic on array columns, one NumPy call per Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VECTOR = T.ArrayType(T.DoubleType())


def to_matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("null vector")
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if flat.size % len(column):
        raise ValueError("vectors of unequal length")
    return flat.reshape(len(column), -1)


def to_lists(matrix: np.ndarray, kind=None) -> pa.ListArray:
    """A matrix as an Arrow column of lists."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1), type=kind))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


@F.arrow_udf(VECTOR)
def _unit(v: pa.Array) -> pa.Array:
    return to_lists(unit_rows(to_matrix(v)), pa.float64()) if len(v) else pa.array([], pa.list_(pa.float64()))


@F.arrow_udf(T.DoubleType())
def _dot(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(np.einsum("ij,ij->i", to_matrix(a), to_matrix(b)) if len(a) else [], pa.float64())


@F.arrow_udf(T.DoubleType())
def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    return pa.array(np.einsum("ij,ij->i", unit_rows(to_matrix(a)), unit_rows(to_matrix(b))), pa.float64())


@F.arrow_udf(VECTOR)
def _cosine_each(v: pa.Array, others: pa.Array) -> pa.Array:
    counts = np.diff(np.asarray(others.offsets))
    if not counts.sum():
        return pa.array([[] for _ in counts], pa.list_(pa.float64()))
    mine = np.repeat(unit_rows(to_matrix(v)), counts, axis=0)
    sims = np.einsum("ij,ij->i", mine, unit_rows(to_matrix(others.flatten())))
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sims))


def as_vector(column: Column) -> Column:
    """Stored float arrays as double arrays."""
    return column.cast(VECTOR)


def unit(v: Column) -> Column:
    """The vector scaled to length one."""
    return _unit(as_vector(v))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two array columns."""
    return _dot(as_vector(a), as_vector(b))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns; 0 when either is a zero vector."""
    return _cosine(as_vector(a), as_vector(b))


def cosine_each(v: Column, others: Column) -> Column:
    """Cosine similarity of a vector to every vector of a list, in list order."""
    return _cosine_each(as_vector(v), others.cast(T.ArrayType(VECTOR)))
