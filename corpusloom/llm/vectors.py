"""Arrow columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def valid_rows(column: pa.Array, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and matrix (doubles) of the vectors that ``keep`` allows, that are not null and hold finite numbers only.
    Shorter vectors are filled with zeros up to the longest of the batch."""
    keep = keep & np.array(column.is_valid())
    column = column.cast(pa.list_(pa.float64()))
    size = np.where(keep, np.array(column.value_lengths().fill_null(0)), 0).astype(np.int64)
    out = np.zeros((len(column), int(size.max(initial=0))))
    begin = np.array(column.offsets)[:-1].astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)  # null components become NaN
    row = np.repeat(np.arange(len(column)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[row, place] = values[begin[row] + place]
    at = np.flatnonzero(keep & np.isfinite(out).all(axis=1))
    return at, out[at]


def wide(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with the columns of the wider; the new ones are zero."""
    d = max(a.shape[1], b.shape[1])
    return tuple(m if m.shape[1] == d else np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (a, b))


def best(group: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's k highest scores, ties to the smaller id; by group, then rank."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.empty(0, int)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
    return order[rank < k]
