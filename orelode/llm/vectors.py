"""What the two vector operators share: which vectors take part, and their binary form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def usable(vector: Column) -> Column:
    """Not NULL, not zero, no NULL, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_rows(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part; components as float if they are, else double."""
    kind = rows.schema[vector].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    column = F.col(vector).cast("array<float>" if single else "array<double>")
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), column.alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))


def is_single(rows: DataFrame) -> bool:
    return isinstance(rows.schema["vector"].dataType.elementType, FloatType)


def by_dimension(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix for each dimension that occurs in a list column."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        out.append((at, flat.reshape(len(at), int(d))))
    return out


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, without overflow or underflow on the way."""
    m = matrix.astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def binary(matrix: np.ndarray) -> pa.Array:
    """One binary value per row, without a copy of each."""
    data = np.ascontiguousarray(matrix)
    width = data.dtype.itemsize * data.shape[1]
    offsets = np.arange(0, len(data) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """The rows of a binary column, all of one width."""
    if not len(column):
        return np.zeros((0, 0), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)
