"""Vectors: which take part, and cosines in double precision that do not depend on the order of work."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row dot products, summed from the first component to the last."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(dots(rows, rows))


def matrix(batch_column) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    lists = batch_column.combine_chunks() if hasattr(batch_column, "combine_chunks") else batch_column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)
