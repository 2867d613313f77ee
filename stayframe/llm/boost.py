"""Gradient-boosted trees for small training sets (a bounded number of rows on
the driver), as arrays that travel to the tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: node arrays [trees, nodes]."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability per row of [rows, features]."""
        rows, out = np.arange(len(x)), np.full(len(x), self.bias)
        depth = self.leaf.shape[1].bit_length() - 1
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += leaf[node - len(f)]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
        ridge: float = 1.0) -> Trees:
    """Logistic boosting with Newton leaves; splits at feature quantiles."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # x > cut[b-1]
    width = bins + 1
    flat = code + np.arange(d) * width
    bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    margin = np.full(n, bias)
    features, values, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        f, c = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        node = np.zeros(n, np.int64)
        for at in range(len(f)):
            rows = np.nonzero(node == at)[0]
            if len(rows) >= 2:
                keys = flat[rows].ravel()
                gs = np.bincount(keys, np.repeat(g[rows], d), d * width).reshape(d, width).cumsum(1)
                hs = np.bincount(keys, np.repeat(h[rows], d), d * width).reshape(d, width).cumsum(1)
                gt, ht = gs[0, -1], hs[0, -1]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                j, b = np.unravel_index(np.argmax(gain[:, :-1]), (d, width - 1))
                if gain[j, b] > 1e-6 and b < len(cuts[j]):
                    f[at], c[at] = j, cuts[j][b]
            node[rows] = 2 * at + 1 + (x[rows, f[at]] > c[at])
        node -= len(f)
        size = 1 << depth
        leaf = rate * np.bincount(node, g, size) / (np.bincount(node, h, size) + ridge)
        margin += leaf[node]
        features.append(f), values.append(c), leaves.append(leaf)
    return Trees(np.array(features), np.array(values), np.array(leaves), bias)
