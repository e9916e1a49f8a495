"""Vectors of Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a column of lists as doubles (null entries as NaN),
    where each list begins and how long it is (-1: null)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_list(column.type.value_type))
    offsets = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    sizes[column.is_null().to_numpy(zero_copy_only=False)] = -1
    return values, offsets[:-1], sizes


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a column of lists that hold ``dim`` finite entries, and
    these as a matrix of doubles."""
    values, begin, sizes = flat(column)
    rows = np.flatnonzero(sizes == dim)
    m = values[begin[rows][:, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim))
    good = np.isfinite(m).all(axis=1)
    return rows[good], m[good]


def dimension(df: DataFrame, col: str) -> int:
    """The commonest length of the column's vectors (the smaller of two that
    are as common); 0 where there is none. One count of lengths."""
    size = F.size(col)
    top = df.where(F.col(col).isNotNull()).groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").first()
    return top["size"] if top else 0
