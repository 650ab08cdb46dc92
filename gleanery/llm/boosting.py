"""Histogram gradient-boosted trees for a binary label, in numpy.

Training bins every feature once and grows depth-limited trees level by level from
gradient histograms. A model is a handful of flat arrays, the children of node i at
``left[i]`` and ``right[i]``; traversal moves all rows of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float
    depth: int
    roots: np.ndarray  # first node of each tree
    feature: np.ndarray
    threshold: np.ndarray  # a row goes left if its feature is <= threshold
    left: np.ndarray
    right: np.ndarray  # a leaf is its own child
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        if not len(x):
            return np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(np.asarray(x, np.float64)), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between neighbouring distinct quantiles."""
    at = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
    return (at[1:] + at[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        bins: int = 64, l2: float = 1.0, least: int = 10) -> Trees:
    """Boost ``trees`` trees on the logistic loss.

    No rows: a constant score close to 1. One label only: a constant score from
    that label's (smoothed) share.
    """
    n, positives = len(y), float(np.sum(y))
    share = (positives + 1.0) / (n + 1.0 + (n > 0))
    base = float(np.log(share / max(1.0 - share, 1e-9)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if 0 < positives < n:
        x = np.asarray(x, np.float64)
        width = x.shape[1]
        cuts = [_edges(x[:, f], bins) for f in range(width)]
        codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
        offsets = np.arange(width) * (bins + 1)
        total = np.full(n, base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-total))
            grad, hess = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
            level = [(roots[-1], np.arange(n))]
            for d in range(depth + 1):
                below = []
                for node, rows in level:
                    g, h = grad[rows].sum(), hess[rows].sum()
                    nodes[node][4] = -rate * g / (h + l2)
                    split = None
                    if d < depth and len(rows) >= 2 * least:
                        flat = (codes[rows] + offsets).ravel()
                        size = width * (bins + 1)
                        gl = np.bincount(flat, np.repeat(grad[rows], width), size).reshape(width, -1).cumsum(1)
                        hl = np.bincount(flat, np.repeat(hess[rows], width), size).reshape(width, -1).cumsum(1)
                        cl = np.bincount(flat, minlength=size).reshape(width, -1).cumsum(1)
                        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
                        gain[(cl < least) | (len(rows) - cl < least)] = -np.inf
                        f, b = divmod(int(gain.argmax()), bins + 1)
                        if gain[f, b] > 1e-6 and b < len(cuts[f]):
                            split = f, b
                    if split is None:
                        total[rows] += nodes[node][4]
                        continue
                    f, b = split
                    goes_left = codes[rows, f] <= b
                    one, two = len(nodes), len(nodes) + 1
                    nodes += [[0, np.inf, one, one, 0.0], [0, np.inf, two, two, 0.0]]
                    nodes[node][:4] = [f, cuts[f][b], one, two]
                    below += [(one, rows[goes_left]), (two, rows[~goes_left])]
                level = below
    table = np.array(nodes, float).reshape(-1, 5)
    return Trees(
        base, depth, np.array(roots, np.int64), table[:, 0].astype(np.int64), table[:, 1],
        table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4],
    )
