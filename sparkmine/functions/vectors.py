"""Expressions over ``array<double>`` columns and the Arrow view of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_vector(*cols: Column | str) -> Column:
    """Columns in the given order as one ``array<double>``."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def squared_l2(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v
    )


def minkowski(a: Column, b: Column, p: int = 2) -> Column:
    """Euclidean distance for ``p=2``, Manhattan distance for every other ``p``."""
    if p == 2:
        return F.sqrt(squared_l2(a, b))
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v
    )


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column as a 2-D array, without a copy per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def list_array(m: np.ndarray) -> pa.Array:
    """A 2-D array as an Arrow list column."""
    n, d = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32)[: n + 1]) if d else pa.array(
        np.zeros(n + 1, dtype=np.int32)
    )
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel()))


def distances(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    """Distance of every row of ``a`` to every row of ``b`` inside one task.

    Wide Euclidean input goes through a matrix product; entries small enough for
    cancellation to matter are computed again as plain differences.
    """
    out = powers(a, b, p)
    return np.sqrt(out, out=out) if p == 2 else out


NARROW = 12  # up to as many columns, distances are plain differences


def powers(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    """The distances before their root is taken: squares for ``p=2``, the distances themselves for every other ``p``."""
    if p != 2 or a.shape[1] <= NARROW:
        out, diff = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
        for j in range(a.shape[1]):
            into = diff if j else out
            np.subtract(a[:, j, None], b[None, :, j], out=into)
            np.multiply(into, into, out=into) if p == 2 else np.abs(into, out=into)
            if j:
                out += diff
        return out
    na = np.einsum("ij,ij->i", a, a)
    nb = np.einsum("ij,ij->i", b, b)
    sq = (-2.0 * a) @ b.T
    sq += na[:, None]
    sq += nb
    if not sq.size:
        return sq
    some = np.flatnonzero(~(sq.min(axis=1) > 1e-6 * (na + nb.max())))  # rows that may hold such an entry
    rows, cols = np.nonzero(sq[some] <= 1e-6 * (na[some, None] + nb[None, :]))
    rows = some[rows]
    np.maximum(sq, 0.0, out=sq)
    for start in range(0, len(rows), 65536):
        r, c = rows[start : start + 65536], cols[start : start + 65536]
        diff = a[r] - b[c]
        sq[r, c] = np.einsum("ij,ij->i", diff, diff)
    return sq


def floor_terms(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Single-precision factors ``f, g`` and a scale: ``scale * (f @ g)`` lies a little below the squared distances of the rows.

    Rows are centred and scaled to at most one. The sums of ``w + 2`` rounded products are off by less than ``(w + 5) * 2**-24`` of
    twice the squared norms; twice as much is taken from the norms, so no square is below its floor. None if squares overflow.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        middle = b.mean(axis=0)
        a, b = a - middle, b - middle
        na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        scale = max(na.max(), nb.max())
    if not np.isfinite(scale):
        return None
    scale = float(scale) if scale > 1e-290 else 1.0
    less, unit = 1 - 4 * (a.shape[1] + 8) * 2.0 ** -24, scale ** -0.5
    f, g = np.ones((len(a), a.shape[1] + 2), np.float32), np.ones((a.shape[1] + 2, len(b)), np.float32)
    f[:, :-2], f[:, -2] = a * (-2 * unit), na / scale * less - 1e-30
    g[:-2], g[-1] = (b * unit).T, nb / scale * less - 1e-30
    return f, g, scale


def paired_squares(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Squared distances of the listed pairs, as plain differences."""
    out, step = np.empty(len(rows)), max(1, (1 << 20) // max(1, a.shape[1]))
    for start in range(0, len(rows), step):
        s = slice(start, start + step)
        diff = a[rows[s]] - b[cols[s]]
        out[s] = np.einsum("ij,ij->i", diff, diff)
    return out
