"""Banded alignment of many pairs at once."""

from __future__ import annotations

import numpy as np


def banded_distance(left: list[np.ndarray], right: list[np.ndarray], band: int) -> np.ndarray:
    """Edit distance of each pair of sequences if it is at most ``band``, else ``band + 1``.

    All pairs go through the rows of the table together; a row holds the 2 * band + 1 cells around the diagonal.
    """
    m = len(left)
    out = np.full(m, band + 1, np.int32)
    if not m:
        return out
    la, lb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    todo = np.flatnonzero(np.abs(la - lb) <= band)
    todo = todo[np.argsort(la[todo], kind="stable")]
    width = 2 * band + 1
    for at in range(0, len(todo), 256):
        pick = todo[at : at + 256]
        n, top = len(pick), int(la[pick].max(initial=0))
        a = np.full((n, top + 1), -1, np.int64)
        b = np.full((n, top + 2 * width + 2), -2, np.int64)
        for r, p in enumerate(pick):
            a[r, : la[p]] = left[p]
            b[r, band : band + min(lb[p], top + band)] = right[p][: top + band]
        big = np.int32(1 << 28)
        j = np.arange(width, dtype=np.int32)
        row = np.where(j >= band, j - band, big).astype(np.int32) * np.ones((n, 1), np.int32)
        result = np.where(la[pick] == 0, lb[pick], big)
        for i in range(top):
            # cell j of row i stands for column i + j - band of the right-hand sequence
            diagonal = row + (b[:, i : i + width] != a[:, i : i + 1])
            up = np.concatenate([row[:, 1:], np.full((n, 1), big, np.int32)], 1) + 1
            row = np.minimum(diagonal, up)
            row[:, j < band - i - 1] = big
            if i + 1 <= band:
                row[:, band - i - 1] = i + 1
            row = np.minimum.accumulate(row - j, 1) + j
            ends = np.flatnonzero(la[pick] == i + 1)
            if len(ends):
                result[ends] = row[ends, lb[pick][ends] - (i + 1) + band]
        out[pick] = np.minimum(result, band + 1)
    return out
