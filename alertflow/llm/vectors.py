"""Vector columns: which rows take part, integer components, Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Scaled components up to this size keep every sum of the integer operators inside 64 bits.
LARGEST = 1 << 27


def doubles(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda x: x.cast("double"))


def all_finite(vec: Column) -> Column:
    """True for arrays without null, NaN or infinite components; never null."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def small_enough(vec: Column, scale: float) -> Column:
    return F.forall(vec, lambda x: F.abs(x * F.lit(scale)) < F.lit(float(LARGEST)))


def floors(vec: Column, scale: float) -> Column:
    """``floor(scale * x)`` of each component, as integers."""
    return F.transform(vec, lambda x: F.floor(x * F.lit(scale)).cast("int"))


def matrix(col: pa.Array, dtype=np.int64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if not len(col):
        return np.zeros((0, 0), dtype)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(dtype)


def lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists."""
    n, width = m.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(np.ascontiguousarray(m).ravel(), kind))
