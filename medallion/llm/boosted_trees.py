"""Histogram gradient-boosted trees for logistic loss, in numpy.

Values are cut into at most ``BINS`` bins at quantiles of the training rows. Each level of a tree sums gradients and
hessians of its rows by (node, bin), one ``bincount`` a feature, and splits each node at the best gain. A tree is a
complete binary tree in heap order (children of k: 2k+1, 2k+2); a node that isn't split sends every row left. All
trees lie in flat arrays, so rows go down a tree together, one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """``feature`` and ``threshold`` (trees x inner nodes), ``value`` (trees x leaves), ``base`` (log-odds)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    @property
    def depth(self) -> int:
        return int(self.value.shape[1]).bit_length() - 1

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def cuts(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of the bins of every feature (values up to the edge belong to the bin; the last bin is open)."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:], method="lower"))
        out.append(values[:-1])
    return out


def _best_splits(grad: np.ndarray, hess: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of the best split of each node, from (feature, node, bin) sums."""
    g, h = grad.cumsum(2), hess.cumsum(2)
    total_g, total_h = g[:, :, -1:], h[:, :, -1:]
    gain = g**2 / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2) - total_g**2 / (total_h + l2)
    gain[(h < least) | (total_h - h < least)] = -np.inf
    flat = gain.transpose(1, 0, 2).reshape(gain.shape[1], -1)
    best = flat.argmax(1)
    return flat[np.arange(len(best)), best], best // gain.shape[2], best % gain.shape[2]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, l2: float = 1.0, least: float = 1.0, bins: int = BINS) -> Trees:
    """Trees for rows ``x`` with labels ``y`` in 0 to 1. Without rows: probability 0.5 everywhere."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not len(x):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    edges = cuts(x, bins)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])  # feature x row
    trees = Trees(np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves)), base)
    score = np.full(len(x), base)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            k, first = 1 << level, (1 << level) - 1
            at = (node - first) * bins
            sums = [[np.bincount(at + b, w, k * bins).reshape(k, bins) for b in binned] for w in (grad, hess)]
            gain, feature, cut = _best_splits(np.array(sums[0]), np.array(sums[1]), l2, least)
            for j in np.flatnonzero(gain > 1e-6):
                trees.feature[t, first + j] = feature[j]
                trees.threshold[t, first + j] = edges[feature[j]][cut[j]]
            node = 2 * node + 1 + (x[np.arange(len(x)), trees.feature[t, node]] > trees.threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        trees.value[t] = -rate * g / (h + l2)
        score += trees.value[t, leaf]
    return trees
