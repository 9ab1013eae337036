"""Arithmetic on unevaluated sums of two doubles by error-free transformations.

A number is a pair (high, low) of arrays, |low| at most half a unit in the last
place of high: about 106 bits.
"""

from __future__ import annotations

import numpy as np

Pair = tuple[np.ndarray, np.ndarray]
#: parts a double into two of 26 bits
SPLITTER = float((1 << 27) + 1)


def two_sum(a, b) -> Pair:
    """a + b rounded, and exactly what rounding left."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def quick_two_sum(a, b) -> Pair:
    """As ``two_sum``, for |a| >= |b|."""
    s = a + b
    return s, b - (s - a)


def halves(a) -> Pair:
    c = SPLITTER * a
    high = c - (c - a)
    return high, a - high


def two_prod(a, b, a_halves: Pair | None = None, b_halves: Pair | None = None) -> Pair:
    """a * b rounded, and exactly what rounding left."""
    p = a * b
    (ah, al), (bh, bl) = a_halves or halves(a), b_halves or halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def add(x: Pair, y: Pair) -> Pair:
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = quick_two_sum(s, e + t)
    return quick_two_sum(s, e + f)


def mul(x: Pair, y: Pair) -> Pair:
    p, e = two_prod(x[0], y[0])
    return quick_two_sum(p, e + (x[0] * y[1] + x[1] * y[0]))


def div(x: Pair, y: Pair) -> Pair:
    q = x[0] / y[0]
    p = mul((q, np.zeros_like(q)), y)
    r = add(x, (-p[0], -p[1]))
    return quick_two_sum(q, r[0] / y[0])


def of_integers(a: np.ndarray) -> Pair:
    """Integers (64-bit, or Python's) as pairs; exact to 106 bits."""
    high = a.astype(np.float64)
    if a.dtype == object:
        return high, np.array([float(v - int(h)) for v, h in zip(a.ravel(), high.ravel(), strict=True)]).reshape(a.shape)
    back = np.where(np.abs(high) < 2.0**63, high, 0).astype(np.int64)
    return high, np.where(np.abs(high) < 2.0**63, a - back, 0).astype(np.float64)


def sum_rows(x: Pair) -> Pair:
    """Sum along the first axis, by halves."""
    high, low = x
    while len(high) > 1:
        m = len(high) // 2
        h, e = add((high[:m], low[:m]), (high[m : 2 * m], low[m : 2 * m]))
        high, low = (np.concatenate([h, high[2 * m :]]), np.concatenate([e, low[2 * m :]])) if len(high) % 2 else (h, e)
    return (high[0], low[0]) if len(high) else (np.zeros(high.shape[1:]), np.zeros(high.shape[1:]))


def matmul(x: Pair, y: Pair) -> Pair:
    """Matrix product, one rank at a time."""
    total = np.zeros((x[0].shape[0], y[0].shape[1])), np.zeros((x[0].shape[0], y[0].shape[1]))
    for k in range(x[0].shape[1]):
        total = add(total, mul((x[0][:, k, None], x[1][:, k, None]), (y[0][None, k], y[1][None, k])))
    return total
