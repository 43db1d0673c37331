"""Helpers for tables of embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & fine


def width(vectors: DataFrame, vector: str) -> int:
    """Components of the longest vector, 0 without vectors; shorter vectors count as filled up with zeros."""
    return vectors.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.ChunkedArray, components: int) -> np.ndarray:
    """Rows of a list column as float64, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == components).all():
        return flat.reshape(-1, components)
    out = np.zeros((len(sizes), components))
    out[np.arange(components) < sizes[:, None]] = flat
    return out
