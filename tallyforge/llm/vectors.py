"""Vectors of an Arrow batch as matrices of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lengths(column: pa.Array) -> np.ndarray:
    """Entries of each list; -1 for a null one."""
    return pc.fill_null(pc.list_value_length(column).cast(pa.int64()), -1).to_numpy(zero_copy_only=False)


def finite_rows(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of exactly ``size`` entries, none null or not finite: their places, and a matrix."""
    have = lengths(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null entries are NaN
    rows = np.flatnonzero(have == size)
    starts = np.cumsum(np.maximum(have, 0)) - np.maximum(have, 0)
    found = values[starts[rows, None] + np.arange(size)] if size else np.empty((len(rows), 0))
    whole = np.isfinite(found).all(axis=1)
    return rows[whole], found[whole]


def whole_numbers(values: np.ndarray, limit: int = 1 << 62) -> np.ndarray:
    """Floors as 64-bit integers; what is beyond ``limit`` is held at it."""
    return np.clip(np.floor(values), -float(limit), float(limit)).astype(np.int64)
