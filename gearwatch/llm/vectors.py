"""Whole-number vectors shared by the vector operators."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Components beyond this count as this, so that products of hundreds of components fit a long.
BOUND = 2**27


def whole_vectors(df: DataFrame, vector_col: str, scale: int, name: str, dims: int | None = None) -> DataFrame:
    """Rows whose vector has ``dims`` components (any number if None), none null or non-finite,
    with ``floor(scale * x)`` of each as array<int> ``name``; ``vector_col`` goes."""
    given = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("_given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    right = finite if dims is None else finite & (F.size("_given") == dims)
    whole = F.transform("_given", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(BOUND))), F.lit(-float(BOUND)))).cast("int"))
    others = [F.col(f"`{c}`") for c in df.columns if c != vector_col]
    return df.select(*others, given.alias("_given")).where(F.col("_given").isNotNull() & right).withColumn(name, whole).drop("_given")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def ragged_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column as rows of longs, shorter lists filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two whole-number matrices, exactly."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


