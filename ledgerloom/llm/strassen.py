"""Exact products of integer matrices by Strassen's recursion."""

from __future__ import annotations

import numpy as np

#: Below this, in rows, columns or the length summed over, a product is taken directly.
LEAF = 16


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 tiles by seven half-sized products and fifteen additions.

    Odd sizes are padded with a row or column of zeros, which is cut off again. Only additions,
    subtractions and products occur, all exact; int64 wraps around, so what grows too
    large on the way still ends right if the result itself has its place in 64 bits.
    """
    n, k = a.shape
    m = b.shape[1]
    if min(n, k, m) <= LEAF:
        return a @ b
    i, j, l = -(-n // 2), -(-k // 2), -(-m // 2)
    a, b = _padded(a, 2 * i, 2 * j), _padded(b, 2 * j, 2 * l)
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]

    lower = a21 + a22
    shifted = lower - a11
    across = b12 - b11
    rest = b22 - across
    first = multiply(a11, b11)
    common = first + multiply(shifted, rest)
    low = common + multiply(a11 - a21, b22 - b12)
    outer = multiply(lower, across)

    product = np.empty((2 * i, 2 * l), np.int64)
    product[:i, :l] = first + multiply(a12, b21)
    product[:i, l:] = common + outer + multiply(a12 - shifted, b22)
    product[i:, :l] = low - multiply(a22, rest - b21)
    product[i:, l:] = low + outer
    return product[:n, :m]


def _padded(tile: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if tile.shape == (rows, columns):
        return tile
    wider = np.zeros((rows, columns), np.int64)
    wider[: tile.shape[0], : tile.shape[1]] = tile
    return wider
