"""Vector columns: which rows take part, Arrow batches as matrices, bounded pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIVOT_SAMPLE = 4096  # rows from which pivots are chosen, by the order of a hash of their id


def finite(vector: str) -> Column:
    """True if the vector is not null and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def sample(df: DataFrame, id_col: str, vector: str, rows: int = PIVOT_SAMPLE) -> np.ndarray:
    """A bounded matrix of rows, the same at every run; only a choice of pivots depends on it."""
    some = df.orderBy(F.xxhash64(id_col), id_col).limit(rows).select(vector).collect()
    return np.array([r[0] for r in some], dtype=np.float64).reshape(len(some), -1)


def spread_out(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the unit vectors, each as far as can be from those chosen before."""
    chosen = [0]
    nearest = points @ points[0]
    while len(chosen) < min(count, len(points)):
        nxt = int(np.argmin(nearest))
        if nearest[nxt] > 1 - 1e-9:
            break
        chosen.append(nxt)
        nearest = np.maximum(nearest, points @ points[nxt])
    return points[chosen]
