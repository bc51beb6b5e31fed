"""Small gradient-boosted trees and isotonic calibration in numpy.

Fitted on a bounded sample on the driver; the fitted model is a few kilobytes and scores
whole batches of feature rows inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BoostedTrees:
    """Binary log-loss boosting of full binary trees of fixed depth over quantile cuts."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    cuts: int = 32
    least_leaf: float = 1.0
    l2: float = 1.0
    start: float = 0.0
    trees: list = field(default_factory=list)  # (feature, threshold of each inner node, leaf values)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        self.trees = []
        if not len(y) or y.min() == y.max():
            return self
        points = [np.unique(np.quantile(c, np.linspace(0, 1, self.cuts + 1)[1:-1])) for c in x.T]
        # A feature that is mostly zero still needs cuts among its other values.
        points = [
            np.unique(np.r_[p, np.quantile(c[c != 0], np.linspace(0, 1, 9)), 0.0]) if (c != 0).any() else p
            for p, c in zip(points, x.T)
        ]
        binned = np.stack([np.searchsorted(p, c, side="left") for p, c in zip(points, x.T)], axis=1)
        width = max(len(p) for p in points) + 1
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = sigmoid(margin)
            tree = self._tree(binned, points, width, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._tree_values(tree, x)
        return self

    def _tree(self, binned, points, width, g, h):
        node = np.zeros(len(g), np.int64)
        features, thresholds = [], []
        for level in range(self.depth):
            count = 1 << level
            best = np.full(count, -1.0)
            feature = np.zeros(count, np.int64)
            threshold = np.full(count, np.inf)
            at = np.zeros(count, np.int64)
            for f in range(binned.shape[1]):
                key = node * width + binned[:, f]
                gs = np.bincount(key, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(key, h, count * width).reshape(count, width).cumsum(1)
                left_g, left_h = gs[:, : len(points[f])], hs[:, : len(points[f])]
                right_g, right_h = gs[:, -1:] - left_g, hs[:, -1:] - left_h
                gain = left_g**2 / (left_h + self.l2) + right_g**2 / (right_h + self.l2)
                gain[(left_h < self.least_leaf) | (right_h < self.least_leaf)] = -1.0
                if not gain.shape[1]:
                    continue
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best
                best[better], feature[better], at[better] = top[better], f, k[better]
                threshold[better] = points[f][k[better]]
            features.append(feature)
            thresholds.append(threshold)
            value = binned[np.arange(len(node)), feature[node]]
            node = 2 * node + ((value > at[node]) & np.isfinite(threshold[node]))
        leaves = 1 << self.depth
        leaf = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
        return features, thresholds, leaf

    @staticmethod
    def _tree_values(tree, x: np.ndarray) -> np.ndarray:
        features, thresholds, leaf = tree
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for feature, threshold in zip(features, thresholds):
            node = 2 * node + (x[rows, feature[node]] > threshold[node])
        return leaf[node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += self._tree_values(tree, x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


@dataclass
class Isotonic:
    """Monotone calibration by pooling adjacent violators, linear between the pools' centres."""

    at: np.ndarray
    value: np.ndarray

    @staticmethod
    def fit(score: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        pools: list[list[float]] = []  # sum of scores, sum of labels, rows
        for s, label in zip(score[order].tolist(), y[order].tolist()):
            pools.append([s, label, 1.0])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        if not pools:
            return Isotonic(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        at = np.array([p[0] / p[2] for p in pools])
        # One doubtful row of each class in every pool keeps scores off 0 and 1.
        value = np.array([(p[1] + 0.5) / (p[2] + 1.0) for p in pools])
        return Isotonic(at, np.maximum.accumulate(value))

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.value)
