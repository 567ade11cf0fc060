"""Histogram gradient-boosted trees for a binary label, in numpy, flattened into arrays.

Training is for a bounded sample that fits one process; prediction visits whole batches level by level.
All trees are complete and ``depth`` levels deep: node i has the children 2i+1 and 2i+2, and a node without
a useful split sends every row left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float  # log-odds before any tree
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); larger values go right
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        if len(self.feature):
            inner = self.feature.shape[1]
            trees = np.arange(len(self.feature))
            for start in range(0, len(x), 4096):  # bounds the (rows, trees) temporaries
                part = x[start : start + 4096]
                rows = np.arange(len(part))[:, None]
                node = np.zeros((len(part), len(trees)), dtype=np.int64)
                while node.size and node[0, 0] < inner:
                    right = part[rows, self.feature[trees, node]] > self.threshold[trees, node]
                    node = 2 * node + 1 + right
                total[start : start + 4096] += self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    l2: float = 1.0,
    least_hessian: float = 2.0,
) -> Trees:
    """Fit by second-order boosting of the logistic loss over per-node histograms.

    Without rows of both labels the result is the smoothed share of label 1 for every row.
    """
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            choice = [None] * width
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key, size = local * bins + binned[:, f], width * bins
                gs = np.bincount(key, g, size).reshape(width, bins).cumsum(axis=1)
                hs = np.bincount(key, h, size).reshape(width, bins).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, : len(e)], hs[:, : len(e)], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least_hessian) | (ht - hl < least_hessian)] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k], choice[k] = top[k], (f, cut[k])
            right = np.zeros(n, dtype=bool)
            for k, chosen in enumerate(choice):
                if chosen:
                    f, cut = chosen
                    feature[first + k], threshold[first + k] = f, edges[f][cut]
                    right |= (local == k) & (binned[:, f] > cut)
            node = 2 * node + 1 + right
        at = node - inner
        leaf = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + l2)
        margin = margin + leaf[at]
        features.append(feature), thresholds.append(threshold), values.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))
