"""Gradient-boosted trees on binned features, kept as flat arrays for numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """``feature`` and ``threshold``: (trees, 2**depth - 1) in heap order; ``leaf``: (trees, 2**depth)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def _bin_edges(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        l2: float = 1.0, min_hessian: float = 2.0) -> FlatTrees:
    """Logistic loss; each level of a tree takes every node's best histogram split."""
    n, width = x.shape
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((trees, inner), np.int32)
    threshold = np.full((trees, inner), np.inf, np.float32)
    leaf = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return FlatTrees(base, feature[:0], threshold[:0], leaf[:0])
    edges = [_bin_edges(x[:, j], bins) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width_now = 1 << level
            first = width_now - 1
            at = node - first
            best = np.zeros(width_now)
            for j in range(width):
                key = at * bins + binned[:, j]
                g = np.bincount(key, grad, width_now * bins).reshape(width_now, bins).cumsum(1)
                h = np.bincount(key, hess, width_now * bins).reshape(width_now, bins).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2) - g_all ** 2 / (h_all + l2)
                gain[(h < min_hessian) | (h_all - h < min_hessian)] = 0
                gain = gain[:, :len(edges[j])]
                if not gain.shape[1]:
                    continue
                cut = gain.argmax(1)
                top = gain[np.arange(width_now), cut]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k] = top[k]
                    feature[t, first + k] = j
                    threshold[t, first + k] = edges[j][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, grad, leaves), np.bincount(at, hess, leaves)
        leaf[t] = rate * g / (h + l2)
        margin += leaf[t][at]
    return FlatTrees(base, feature, threshold, leaf)
