"""Small decision trees in numpy, on bounded samples, for models that compile to columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float  # left: value <= threshold
    left: Split | float
    right: Split | float


def cut_points(x: np.ndarray, most: int = 48) -> list[np.ndarray]:
    """Candidate thresholds of each feature: midpoints between its quantiles."""
    out = []
    for k in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, k], np.linspace(0, 1, most), method="nearest"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(x: np.ndarray, target: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], depth: int, least: int, features=None) -> Split | float:
    """A regression tree: the weighted mean of ``target`` at each leaf.

    ``features`` draws the features that a node may use; ties take the first.
    """
    total = weight.sum()
    mean = float((weight * target).sum() / total) if total else 0.0
    if depth == 0 or len(x) < 2 * least or np.ptp(target) < 1e-12:
        return mean
    best: tuple[float, int, float] | None = None
    for k in range(x.shape[1]) if features is None else features():
        c = cuts[k]
        if not len(c):
            continue
        place = np.searchsorted(c, x[:, k], side="left")
        n = np.cumsum(np.bincount(place, minlength=len(c) + 1))[:-1]
        w = np.cumsum(np.bincount(place, weight, len(c) + 1))[:-1]
        s = np.cumsum(np.bincount(place, weight * target, len(c) + 1))[:-1]
        ok = (n >= least) & (len(x) - n >= least) & (w > 0) & (total - w > 0)
        if not ok.any():
            continue
        gain = np.where(ok, s**2 / np.where(ok, w, 1) + (mean * total - s) ** 2 / np.where(ok, total - w, 1), -np.inf)
        j = int(np.argmax(gain))
        if best is None or gain[j] > best[0] + 1e-12:
            best = float(gain[j]), k, float(c[j])
    if best is None or best[0] <= mean * mean * total + 1e-12:
        return mean
    _, k, at = best
    left = x[:, k] <= at
    sides = (grow(x[m], target[m], weight[m], cuts, depth - 1, least, features) for m in (left, ~left))
    return Split(k, at, *sides)


def values(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    left = x[:, tree.feature] <= tree.threshold
    return np.where(left, values(tree.left, x), values(tree.right, x))


def as_sql(tree: Split | float, names: list[str]) -> str:
    """The tree as one SQL expression over columns."""
    if not isinstance(tree, Split):
        return f"{tree!r}D"
    return f"CASE WHEN {names[tree.feature]} <= {tree.threshold!r}D THEN {as_sql(tree.left, names)} ELSE {as_sql(tree.right, names)} END"
