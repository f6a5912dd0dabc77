"""Vectors of Arrow batches as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(column: pa.Array, least_width: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as doubles, filled up with zeros to the longest; their lengths; and which rows are not null and hold finite numbers only.

    A row that is null or holds a null or a number that is not finite comes out as zeros.
    """
    n = len(column)
    lens = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), lens)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    valid = column.is_valid().to_numpy(zero_copy_only=False).copy()
    valid[row[~np.isfinite(flat)]] = False
    out = np.zeros((n, max(least_width, int(lens.max(initial=0)))))
    own = valid[row]
    out[row[own], place[own]] = flat[own]
    return out, lens, valid


def packed(x: np.ndarray, lens: np.ndarray, kind: str) -> pa.Array:
    """Rows as bytes, each with its own length."""
    x = x.astype(kind)
    size = x.dtype.itemsize
    return pa.array([r.tobytes()[: n * size] for r, n in zip(x, lens.tolist(), strict=True)], pa.binary())


def unpacked(rows, kind: str, least_width: int = 0) -> np.ndarray:
    """Packed rows as doubles, filled up with zeros to the longest."""
    rows = list(rows)
    lens = np.array([len(r) for r in rows], np.int64) // np.dtype(kind).itemsize
    width = max(least_width, int(lens.max(initial=0)))
    flat = np.frombuffer(b"".join(rows), kind).astype(np.float64)
    if (lens == width).all():
        return flat.reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    row = np.repeat(np.arange(len(rows)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def kind_of(field) -> str:
    """How a column's numbers are packed without loss: f4 for arrays of float, else f8."""
    return "<f4" if field.dataType.elementType.typeName() == "float" else "<f8"
