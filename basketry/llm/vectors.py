"""Vectors of an Arrow list column as matrices, by dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: str) -> Column:
    """True for vectors that are there and hold finite components only."""
    x = F.col(col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.coalesce(x.isNotNull() & fine, F.lit(False))


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` for each dimension that occurs; components as doubles."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield rows, flat[begin[rows][:, None] + np.arange(d)]
