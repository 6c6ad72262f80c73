"""The E8 lattice: nearest points and the cells beside them."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np


def _shortest() -> np.ndarray:
    """The 240 shortest vectors."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


SHORTEST = _shortest()


def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum: round, and if the sum is odd, the worst one the other way."""
    near = np.rint(y)
    off = y - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(near.sum(axis=1) % 2)
    at = worst[rows]
    near[rows, at] += np.where(off[rows, at] >= 0, 1, -1)
    return near


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row of 8 coordinates."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    closer = ((y - b) ** 2).sum(axis=1) < ((y - a) ** 2).sum(axis=1)
    return np.where(closer[:, None], b, a)


def beside(y: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, order, extra): for each row the nearest point, the places in SHORTEST of the ``many`` next ones among its 240
    neighbours, and how much farther each of these is, in squared distance."""
    own = decode(y)
    if not many:
        return own, np.zeros((len(y), 0), np.int64), np.zeros((len(y), 0))
    extra = 2 - 2 * (y - own) @ SHORTEST.T
    order = np.argpartition(extra, many, axis=1)[:, :many] if many < 240 else np.argsort(extra, axis=1)
    return own, order, np.take_along_axis(extra, order, 1)


def cells(y: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(points, extra): as ``beside``, the nearest point and the next ones together.

    points has shape (rows, 1 + many, 8).
    """
    own, order, extra = beside(y, many)
    points = np.concatenate([own[:, None], own[:, None] + SHORTEST[order]], axis=1)
    return points, np.concatenate([np.zeros((len(y), 1)), extra], axis=1)
