"""Arrow list columns of numbers as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def finite_vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the row numbers and the double matrix of the rows that are no null and all finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    values = column.flatten().cast(pa.float64())
    flat = np.asarray(values.fill_null(float("nan")), dtype=np.float64)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    found = {}
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = flat[starts[rows][:, None] + np.arange(length)]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            found[int(length)] = rows[good], matrix[good]
    return found
