"""Histogram gradient-boosted trees in numpy: fitted on a bounded sample, applied as flat arrays.

Every feature is cut into at most BINS bins at quantiles of the sample. Trees are full binary trees of one depth, grown
level by level from sums of gradients per node, feature and bin. A fitted model is three arrays (feature, threshold,
value) with the children of node n at 2n + 1 and 2n + 2, so all rows go down a tree together, one gather per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_WEIGHT = 1.0
L2 = 2.0


@dataclass
class Trees:
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out, each = np.full(len(rows), self.base), np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[each, feature[node]] > threshold[node])
            out += value[node]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def _grow(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray):
    """One tree: at each node the cut with the largest gain; a node without one sends all rows left."""
    inner, size = 2 ** DEPTH - 1, 2 ** (DEPTH + 1) - 1
    feature, threshold, value = np.zeros(size, np.int32), np.full(size, np.inf), np.zeros(size)
    node = np.zeros(len(binned), np.int64)
    for level in range(DEPTH):
        first, many = 2 ** level - 1, 2 ** level
        best, cut_of = np.zeros(many), {}
        for f in range(binned.shape[1]):
            key = (node - first) * BINS + binned[:, f]
            g = np.bincount(key, gradient, many * BINS).reshape(many, BINS).cumsum(axis=1)
            h = np.bincount(key, weight, many * BINS).reshape(many, BINS).cumsum(axis=1)
            all_g, all_h = g[:, -1:], h[:, -1:]
            gain = g ** 2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g ** 2 / (all_h + L2)
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
            gain[:, len(edges[f]):] = 0
            at = gain.argmax(axis=1)
            for n in np.flatnonzero(gain[np.arange(many), at] > best + 1e-9):
                best[n], cut_of[n] = gain[n, at[n]], (f, at[n])
        right = np.zeros(len(binned), bool)
        for n, (f, at) in cut_of.items():
            feature[first + n], threshold[first + n] = f, edges[f][at]
            own = node == first + n
            right[own] = binned[own, f] > at
        node = 2 * node + 1 + right
    g, h = np.bincount(node - inner, gradient, 2 ** DEPTH), np.bincount(node - inner, weight, 2 ** DEPTH)
    value[inner:] = -RATE * g / (h + L2)
    return (feature, threshold, value), value[node]


def fit(rows: np.ndarray, labels: np.ndarray, unlabelled: float = 1.0) -> Trees:
    """Logistic loss. Without any rows every score is `unlabelled`; with one class alone, near that class."""
    share = (labels.sum() + unlabelled) / (len(labels) + 1)
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    edges, trees, margin = [], [], np.full(len(rows), base)
    if len(np.unique(labels)) > 1:
        for f in range(rows.shape[1]):
            edges.append(np.unique(np.quantile(rows[:, f], np.arange(1, BINS) / BINS, method="lower")))
        binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree, step = _grow(binned, edges, p - labels, p * (1 - p))
            trees.append(tree)
            margin = margin + step
    size = 2 ** (DEPTH + 1) - 1
    arrays = [np.array([t[i] for t in trees]).reshape(len(trees), size) for i in range(3)]
    return Trees(base, arrays[0].astype(np.int32), arrays[1], arrays[2])
