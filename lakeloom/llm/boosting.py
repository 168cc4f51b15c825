"""Gradient-boosted trees for two classes in numpy: histogram splits, logistic loss, second-order leaf values."""

from __future__ import annotations

import numpy as np


class Trees:
    """Complete binary trees of one depth: feature and threshold by inner node, value by leaf."""

    def __init__(self, n_trees: int = 100, depth: int = 5, rate: float = 0.2, bins: int = 48, ridge: float = 1.0, least: float = 0.3):
        self.n_trees, self.depth, self.rate, self.bins, self.ridge, self.least = n_trees, depth, rate, bins, ridge, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])  # bin b: at most edges[b]
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        score = np.full(len(y), self.base)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            feature, bound = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-9)
                local = node - first
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    size = len(e) + 1
                    at = local * size + binned[f]
                    g = np.bincount(at, grad, width * size).reshape(width, size).cumsum(1)
                    h = np.bincount(at, hess, width * size).reshape(width, size).cumsum(1)
                    gain = g**2 / (h + self.ridge) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + self.ridge) - g[:, -1:] ** 2 / (h[:, -1:] + self.ridge)
                    gain[(h < self.least) | (h[:, -1:] - h < self.least)] = 0
                    k = gain[:, :-1].argmax(1)
                    top = gain[np.arange(width), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + width][better] = f
                    bound[first : first + width][better] = e[k[better]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > bound[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, grad, 2**self.depth) / (np.bincount(leaf, hess, 2**self.depth) + self.ridge)
            score += value[leaf]
            self.trees.append((feature, bound, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1."""
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, bound, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            score += value[node - (2**self.depth - 1)]
        return score
