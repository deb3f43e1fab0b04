"""Vectors in Arrow batches as numpy matrices."""

from __future__ import annotations

import numpy as np


def valid_matrix(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """dimension -> (row numbers, float64 matrix) of the vectors that are not
    null and hold no null or non-finite component."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = pc.cast(column.flatten(), pa.float64())
    values = np.asarray(pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False), dtype=np.float64)
    ends = np.cumsum(length)
    out = {}
    for dim in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == dim)
        m = values[(ends[rows] - dim)[:, None] + np.arange(dim)]
        fine = np.isfinite(m).all(axis=1)
        if fine.any():
            out[int(dim)] = (rows[fine], m[fine])
    return out


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def unblob(data: bytes, kind: str, rows: int | None = None) -> np.ndarray:
    a = np.frombuffer(data, dtype=kind)
    return a if rows is None else a.reshape(rows, -1)
