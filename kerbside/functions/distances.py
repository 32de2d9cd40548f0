"""Distances between two blocks of vectors inside a task, by products of matrices.

The square of a distance is |x|^2 + |y|^2 - 2xy, one matrix product for a block. Digits are lost where that is
small beside the norms; there the differences themselves are taken, so what is returned is as exact as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ROWS, COLUMNS = 256, 512       # of a tile of the block, for the core's own cache
LOST = 2e-4                    # share of |x|^2 from which on a square keeps ten digits
PAIRS = 1 << 14                # pairs whose differences are held at once
GROUPS = 256                   # pairs of blocks wanted, so that every core has several
MOST_ROWS = 1 << 15            # rows of a block at most


def block_rows(pairs: int, least: int, most: int = MOST_ROWS) -> int:
    """Rows on a side of a block, for about ``GROUPS`` blocks over so many pairs of rows."""
    return max(1, least, min(most, int((pairs / GROUPS) ** 0.5)))


def plain(vector: str, kind: str) -> Column:
    """The column as it is if it holds floats (half the bytes of doubles in a shuffle), else as doubles."""
    return F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of doubles; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to the same row of ``y``."""
    return np.concatenate([((y[s:s + PAIRS] - x[s:s + PAIRS]) ** 2).sum(1) for s in range(0, len(x), PAIRS)] or [np.zeros(0)])


def exact_at(x: np.ndarray, y: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (row of ``x``, row of ``y``)."""
    parts = (slice(s, s + PAIRS) for s in range(0, len(row), PAIRS))
    return np.concatenate([exact(x[row[p]], y[column[p]]) for p in parts] or [np.zeros(0)])


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that differ, the place of each row among them, and how often each occurs."""
    x = np.ascontiguousarray(x)
    whole = x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
    _, first, back, times = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    return x[first], back.ravel(), times


def _centre(y: np.ndarray) -> np.ndarray:
    centre = y.mean(0)
    return np.where(np.isfinite(centre), centre, 0.0)


def _factors(x: np.ndarray, y: np.ndarray, less: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices whose product holds (1 - less) (|x|^2 + |y|^2) - 2xy."""
    xx, yy = ((1 - less) * (z * z).sum(1) for z in (x, y))
    return np.column_stack([-2 * x, xx, np.ones(len(x))]), np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), yy]).T)


def distance_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the distances of each row of ``x`` to all rows of ``y``; copies within a block cost nothing."""
    (x, back, _), (y, _, times) = _distinct(x), _distinct(y)
    out, times = np.zeros(len(x)), times.astype(float)
    with np.errstate(invalid="ignore", over="ignore"):
        centre = _centre(y)
        left, right = _factors(x - centre, y - centre)
        limit = LOST * left[:, -2:-1]
        for i in range(0, len(x), ROWS):
            for j in range(0, len(y), COLUMNS):
                square = left[i:i + ROWS] @ right[:, j:j + COLUMNS]
                lost = ~(square > limit[i:i + ROWS])
                if lost.any():
                    row, column = np.nonzero(lost)
                    square[row, column] = exact_at(x, y, i + row, j + column)
                out[i:i + ROWS] += np.sqrt(square, out=square) @ times[j:j + COLUMNS]
    return out[back]


def _tiles(n: int) -> Iterator[slice]:
    """Few columns first, so that the nearest so far bound the wider tiles."""
    at, width = 0, 64
    while at < n:
        yield slice(at, min(at + width, n))
        at, width = at + width, min(2 * width, COLUMNS)


class _Screen:
    """Which pairs may be as near as a limit: by single precision, by double where that tells too little."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        centre = _centre(y)
        x, y = x - centre, y - centre
        self.scale = max(np.abs(x).max(initial=0.0), np.abs(y).max(initial=0.0)) or 1.0
        x, y = x / self.scale, y / self.scale
        places = x.shape[1] + 16
        # a square less than the true one by more than rounding can add, so that no pair is passed over by it
        self.sides = [[f.astype(kind) for f in _factors(x, y, places * less)]
                      for kind, less in ((np.float32, 2.4e-7), (np.float64, 1e-15))]

    def near(self, rows: slice, columns: slice, limit: np.ndarray) -> np.ndarray:
        bound = ((limit / self.scale) ** 2 * (1 + 1e-6) + 1e-36)[:, None]
        found = None
        for left, right in self.sides:
            some = left[rows] @ right[:, columns] > bound.astype(left.dtype)
            np.logical_not(some, out=some)                  # what is no number stays in
            found = some if found is None else found & some
            if np.count_nonzero(found) * 16 <= found.size:
                break
        return found


def nearest(x: np.ndarray, x_ids: np.ndarray, y: np.ndarray, y_ids: np.ndarray, k: int,
            bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``x``, row of ``y``, distance): the ``k`` nearest of another id, by distance and id.

    ``bound``: what is farther than that from a row of ``x`` is not asked for. Vectors are finite.
    """
    out = []
    with np.errstate(invalid="ignore", over="ignore"):
        screen = _Screen(x, y) if len(x) and len(y) else None
        for i in range(0, len(x) if screen else 0, ROWS):
            rows = slice(i, min(i + ROWS, len(x)))
            limit = np.full(rows.stop - i, np.inf) if bound is None else bound[rows].copy()
            d, at = np.full((len(limit), k), np.inf), np.full((len(limit), k), -1)
            for columns in _tiles(len(y)):
                some = screen.near(rows, columns, limit)
                if not some.any():
                    continue
                row, column = np.divmod(np.flatnonzero(some), some.shape[1])
                column += columns.start
                far = np.sqrt(exact_at(x, y, i + row, column))
                keep = (far <= limit[row]) & (x_ids[i + row] != y_ids[column]) & np.isfinite(far)
                row, column, far = row[keep], column[keep], far[keep]
                if not len(row):
                    continue
                touched = np.unique(row)
                held = at[touched] >= 0
                row = np.concatenate([row, np.repeat(touched, held.sum(1))])
                column, far = np.concatenate([column, at[touched][held]]), np.concatenate([far, d[touched][held]])
                order = np.lexsort((y_ids[column], far, row))
                row, column, far = row[order], column[order], far[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                first = place < k
                d[row[first], place[first]], at[row[first], place[first]] = far[first], column[first]
                limit[touched] = np.minimum(limit[touched], d[touched, k - 1])
            row, place = np.nonzero(at >= 0)
            out.append((i + row, at[row, place], d[row, place]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*out))
