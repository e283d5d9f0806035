"""Small regression trees on the driver, for boosting and for forests.

They are fitted on bounded samples of labelled candidates, never on a table.
"""

from __future__ import annotations

import numpy as np

BINS = 64


def cut_points(x: np.ndarray) -> list[np.ndarray]:
    """Up to BINS - 1 thresholds for each feature."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def grow(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float, least: float, pick: float, rng: np.random.Generator) -> list[tuple]:
    """Nodes (feature, threshold, left, right, value); a leaf has feature -1. Go left at most the threshold."""
    nodes: list[tuple] = []

    def build(rows: np.ndarray, left_depth: int) -> int:
        me = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append((-1, 0.0, 0, 0, float(g / (h + ridge))))
        if left_depth == 0 or h < 2 * least:
            return me
        best = (1e-9, -1, 0)
        width = bins.shape[1]
        for j in np.flatnonzero(rng.random(width) < pick) if pick < 1 else range(width):
            b = bins[rows, j]
            gs, hs = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1], np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
            gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
            gain[(hs < least) | (h - hs < least) | (np.arange(BINS - 1) >= len(cuts[j]))] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], int(j), at)
        _, j, at = best
        if j >= 0:
            low = bins[rows, j] <= at
            nodes[me] = (j, float(cuts[j][at]), build(rows[low], left_depth - 1), build(rows[~low], left_depth - 1), nodes[me][4])
        return me

    build(np.arange(len(bins)), depth)
    return nodes


def tree_values(tree: list[tuple], x: np.ndarray) -> np.ndarray:
    feature, threshold, left, right, value = (np.array(c) for c in zip(*tree))
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return value[at]
        node = at[inner]
        low = x[inner, feature[node]] <= threshold[node]
        at[inner] = np.where(low, left[node], right[node])


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, seed: int = 7) -> list[list[tuple]]:
    """Trees whose values, scaled by the rate, sum to log-odds."""
    cuts = cut_points(x)
    bins, f, rng, trees = binned(x, cuts), np.zeros(len(x)), np.random.default_rng(seed), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        tree = [(j, t, a, b, v * rate) for j, t, a, b, v in grow(bins, cuts, y - p, p * (1 - p) + 1e-6, depth, 1.0, 1.0, 1.0, rng)]
        trees.append(tree)
        f += tree_values(tree, x)
    return trees


def forest(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 6, seed: int = 7) -> list[list[tuple]]:
    """Trees on bootstrap samples and random features; the mean of their values is the share of label 1."""
    cuts = cut_points(x)
    bins, rng, out = binned(x, cuts), np.random.default_rng(seed), []
    pick = min(1.0, max(0.3, 1.5 / np.sqrt(x.shape[1])))
    for _ in range(trees):
        rows = rng.integers(0, len(x), len(x))
        out.append(grow(bins[rows], cuts, y[rows].astype(float), np.ones(len(rows)), depth, 1e-6, 2.0, pick, rng))
    return out


def calibrate(score: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """Platt's (slope, offset): the probability of label 1 is sigmoid(slope * score + offset). Each score counts `times`, or once."""
    times = np.ones(len(score)) if times is None else times
    n1, n0 = (times * y).sum(), (times * (1 - y)).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    unit = max(float(np.abs(score).max()), 1e-9)
    x = np.stack([score / unit, np.ones(len(score))], axis=1)

    def loss(w: np.ndarray) -> float:
        f = x @ w
        return float((times * (np.logaddexp(0, f) - t * f)).sum() + 1e-3 * w @ w)

    w = np.zeros(2)
    for _ in range(100):  # Newton steps, halved until the loss falls
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = (x * (times * p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (times * (p - t)) + 2e-3 * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    a, b = w[0] / unit, w[1]
    return float(a), float(b)
