"""Helpers of the operators over vectors: usable rows, whole-number components, Arrow to numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole-number components stay below this, so that a squared distance of 2**8 dimensions fits a long.
LARGEST = 2**26


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole_vectors(rows: DataFrame, vector: str, dims: int, scale: int, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep` and v: floor(scale * component) of every usable vector with `dims` components.

    A component whose whole number reaches `LARGEST` is an error, as an
    overflow is: squared distances would no longer fit a long.
    """
    v = F.col(vector).cast("array<double>")
    large = F.exists(v, lambda x: F.abs(x * scale) >= F.lit(float(LARGEST - 1)))
    error = F.raise_error(F.lit(f"a vector component times {scale} is out of range")).cast("array<int>")
    whole = F.when(large, error).otherwise(F.transform(v, lambda x: F.floor(x * scale).cast("int")))
    return rows.where(usable(v) & (F.size(v) == dims)).select(*keep, whole.alias("v"))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int, dtype=np.int64) -> np.ndarray:
    """An Arrow column of lists, all of `dims` values, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), dims).astype(dtype, copy=False)


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), pa.array(rows.reshape(-1)))
