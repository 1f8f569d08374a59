"""Gradient-boosted regression trees on the logistic loss, by histograms, in numpy; for tables that fit a driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Full binary trees of one depth as arrays: a row of a tree goes right where its feature exceeds the threshold."""

    feature: np.ndarray  # trees x (2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2**depth
    start: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, ridge: float = 2.0, least: float = 5.0) -> Trees:
    """`y` 0 or 1. Split candidates are BINS quantiles of each feature; a split keeps `least` curvature on both sides."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1).astype(np.int64)
    share = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    out = Trees(np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)), float(np.log(share / (1 - share))))
    logit = np.full(n, out.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        grad, curve = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            local = at - first
            best = np.zeros(nodes)
            for f in range(width):
                if len(edges[f]) == 0:
                    continue
                cell = local * BINS + binned[:, f]
                g = np.bincount(cell, grad, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                h = np.bincount(cell, curve, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                gain[(h < least) | (ht - h < least)] = 0
                cut = gain[:, : len(edges[f])].argmax(1)
                value = gain[np.arange(nodes), cut]
                better = value > best + 1e-9
                best[better] = value[better]
                out.feature[t, first : first + nodes][better] = f
                out.threshold[t, first : first + nodes][better] = edges[f][cut[better]]
            at = 2 * at + 1 + (x[np.arange(n), out.feature[t][at]] > out.threshold[t][at])
        leaf = at - (2**depth - 1)
        g, h = np.bincount(leaf, grad, 2**depth), np.bincount(leaf, curve, 2**depth)
        out.leaf[t] = -rate * g / (h + ridge)
        logit += out.leaf[t][leaf]
    return out
