"""Embedding columns in Spark and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(col: str) -> Column:
    """Whether the vector is there, has entries, and none is null or not finite."""
    bad = F.exists(col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(F.col(col).isNotNull() & (F.size(col) > 0) & ~bad, F.lit(False))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column, all of ``dim`` entries."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
