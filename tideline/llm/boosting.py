"""Gradient-boosted trees for two classes on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: ``x[feature] > cut`` goes right."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += value[at - (2**depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, penalty: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss; the best split of a level's nodes by histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(1) for j in range(x.shape[1])]
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Trees(edges, np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), 255, np.int64), np.zeros((trees, 2**depth)), float(np.log(share / (1 - share))))
    b = model.bins(x).astype(np.int64)
    logit = np.full(len(x), model.base)
    wide = b + np.arange(x.shape[1]) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p) + 1e-6
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cells = ((at - first)[:, None] * (x.shape[1] * bins) + wide).ravel()
            size = nodes * x.shape[1] * bins
            shape = (nodes, x.shape[1], bins)
            gs = np.bincount(cells, np.repeat(g, x.shape[1]), size).reshape(shape).cumsum(2)
            hs = np.bincount(cells, np.repeat(h, x.shape[1]), size).reshape(shape).cumsum(2)
            gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
            best = gain.reshape(nodes, -1).argmax(1)
            use = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
            model.feature[t, first : first + nodes] = np.where(use, best // bins, 0)
            model.cut[t, first : first + nodes] = np.where(use, best % bins, 255)
            at = 2 * at + 1 + (b[np.arange(len(x)), model.feature[t, at]] > model.cut[t, at])
        leaf = at - (2**depth - 1)
        gsum, hsum = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        model.value[t] = rate * gsum / (hsum + penalty)
        logit += model.value[t, leaf]
    return model
