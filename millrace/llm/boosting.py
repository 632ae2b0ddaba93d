"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Full trees of one depth, grown level by level on logistic loss.

    A tree is arrays of its inner nodes' features and thresholds and its leaves'
    values; node ``i`` has the children ``2 i + 1`` and ``2 i + 2``.
    """

    def __init__(self, trees: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.bias = 0.0
        self.feature = np.zeros((trees, 2**depth - 1), np.int64)
        self.threshold = np.zeros((trees, 2**depth - 1))
        self.leaf = np.zeros((trees, 2**depth))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rows, columns = x.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[1:-1])) for j in range(columns)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        flat = binned + np.arange(columns) * self.bins
        score = np.full(rows, self.bias)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            slope, bend = y - p, p * (1 - p)
            node = np.zeros(rows, np.int64)
            for level in range(self.depth):
                width = 2**level
                size = width * columns * self.bins
                at = (node[:, None] * (columns * self.bins) + flat).ravel()
                shape = (width, columns, self.bins)
                slopes = np.bincount(at, np.repeat(slope, columns), size).reshape(shape).cumsum(axis=2)
                bends = np.bincount(at, np.repeat(bend, columns), size).reshape(shape).cumsum(axis=2)
                whole_s, whole_b = slopes[:, :, -1:], bends[:, :, -1:]
                gain = slopes**2 / (bends + self.ridge) + (whole_s - slopes) ** 2 / (whole_b - bends + self.ridge)
                best = gain.reshape(width, -1).argmax(axis=1)
                feature, cut = best // self.bins, best % self.bins
                for i in range(width):
                    edge = edges[feature[i]]
                    self.feature[t, width - 1 + i] = feature[i]
                    self.threshold[t, width - 1 + i] = edge[cut[i]] if cut[i] < len(edge) else np.inf
                right = x[np.arange(rows), feature[node]] > self.threshold[t, width - 1 + node]
                node = 2 * node + right
            slopes = np.bincount(node, slope, 2**self.depth)
            bends = np.bincount(node, bend, 2**self.depth)
            self.leaf[t] = self.rate * slopes / (bends + self.ridge)
            score += self.leaf[t][node]
        return self

    def decision(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the second class."""
        score = np.full(len(x), self.bias)
        row = np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                inner = 2**level - 1 + node
                node = 2 * node + (x[row, self.feature[t, inner]] > self.threshold[t, inner])
            score += self.leaf[t][node]
        return score
