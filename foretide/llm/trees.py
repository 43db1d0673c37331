"""Gradient-boosted trees over binned features, kept as flat arrays for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: feature and cut per inner node, value per leaf."""

    feature: np.ndarray  # trees x (2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2^depth
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row; all trees walk down one level at a time."""
        n, trees = len(x), np.arange(len(self.feature))
        node = np.zeros((n, len(trees)), np.int64)
        inner = self.feature.shape[1] if len(trees) else 0
        rows = np.arange(n)[:, None]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        total = self.start + (self.leaf[trees, node - inner].sum(1) if len(trees) else 0)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30) * np.ones(n)))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, shrink: float = 2.0
) -> Trees:
    """Boost on the log loss. Without rows, or with one class only, a constant is returned."""
    positive = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(positive / (1 - positive)))
    inner = 2**depth - 1
    feature, cut = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf)
    leaf = np.zeros((rounds, inner + 1))
    if len(y) == 0 or y.min() == y.max():
        return Trees(feature[:0], cut[:0], leaf[:0], start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    total = np.full(len(y), start)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes = 2**level
            gain, best = np.zeros(nodes), np.full((nodes, 2), -1)
            for f, column in enumerate(binned):
                key = node * bins + column
                g = np.bincount(key, grad, nodes * bins).reshape(nodes, bins)
                h = np.bincount(key, hess, nodes * bins).reshape(nodes, bins)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gs, hs = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                won = gl**2 / (hl + shrink) + (gs - gl) ** 2 / (hs - hl + shrink) - gs**2 / (hs + shrink)
                won[:, len(edges[f]):] = 0  # no cut beyond the last edge
                at = won.argmax(1)
                value = won[np.arange(nodes), at]
                better = value > gain + 1e-9
                gain[better] = value[better]
                best[better] = np.stack([np.full(nodes, f), at], 1)[better]
            first = nodes - 1
            right = np.zeros(len(y), bool)
            for k, (f, at) in enumerate(best):
                if f >= 0:
                    feature[t, first + k], cut[t, first + k] = f, edges[f][at]
                    here = node == k
                    right[here] = binned[f][here] > at
            node = 2 * node + right
        g, h = np.bincount(node, grad, inner + 1), np.bincount(node, hess, inner + 1)
        leaf[t] = -rate * g / (h + shrink)
        total += leaf[t][node]
    return Trees(feature, cut, leaf, start)
