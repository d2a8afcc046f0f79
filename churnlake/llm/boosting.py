"""Gradient-boosted trees with logistic loss, small enough to fit on a bounded sample and to ship to tasks.

Features are cut into ``BINS`` quantile bins; trees are complete, of a fixed depth, and stored as arrays, so that scoring is a
few NumPy gathers per level.
"""

from __future__ import annotations

import numpy as np

BINS = 32


def fit_boosted_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, least: int = 10, ridge: float = 1.0) -> dict[str, np.ndarray]:
    """Arrays feature, threshold (trees, inner nodes) and value (trees, leaves), and the first log-odds."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    start = float(np.log(mean / (1 - mean)))
    raw = np.full(n, start)
    inner = 2**depth - 1
    feature, threshold = np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    offsets = np.arange(d) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first = 2**level - 1
            for node in range(first, 2 * first + 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 2 * least:
                    continue
                flat = (binned[rows] + offsets).ravel()
                sums = [np.bincount(flat, weights=np.repeat(w, d), minlength=d * BINS).reshape(d, BINS).cumsum(axis=1) for w in (g[rows], h[rows], np.ones(len(rows)))]
                (gl, hl, nl), (ga, ha) = sums, (g[rows].sum(), h[rows].sum())
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(nl < least) | (len(rows) - nl < least)] = -1
                j, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[j, b] > 1e-9 and b < len(cuts[j]):
                    feature[t, node], threshold[t, node] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > threshold[t, at])
        leaf = at - inner
        value[t] = rate * np.bincount(leaf, weights=g, minlength=inner + 1) / (np.bincount(leaf, weights=h, minlength=inner + 1) + ridge)
        raw += value[t, leaf]
    return {"feature": feature, "threshold": threshold, "value": value, "start": np.array(start)}


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probability of class 1 for each row."""
    raw, rows = np.full(len(x), float(model["start"])), np.arange(len(x))
    inner = model["feature"].shape[1]
    for f, c, v in zip(model["feature"], model["threshold"], model["value"]):
        at = np.zeros(len(x), np.int64)
        for _ in range(inner.bit_length()):
            at = 2 * at + 1 + (x[rows, f[at]] > c[at])
        raw += v[at - inner]
    return 1 / (1 + np.exp(-raw))
