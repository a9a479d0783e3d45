"""Gradient-boosted trees over small tables of features, for classifiers that are fitted on bounded samples and scored in tasks."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Tree(NamedTuple):
    """Node i tests feature[i] <= edge[i] and goes to left[i] or right[i]; a leaf has feature -1 and a value."""

    feature: np.ndarray
    edge: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.value[at]
            lower = x[rows, np.maximum(self.feature[at], 0)] <= self.edge[at]
            at = np.where(inner, np.where(lower, self.left[at], self.right[at]), at)


def _grow(x: np.ndarray, edges: list[np.ndarray], bins: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, least: float, ridge: float) -> Tree:
    feature, edge, left, right, value = [], [], [], [], []

    def node(rows: np.ndarray, level: int) -> int:
        at = len(feature)
        g, h = gradient[rows].sum(), weight[rows].sum()
        for column, empty in ((feature, -1), (edge, 0.0), (left, at), (right, at), (value, -g / (h + ridge))):
            column.append(empty)
        if level == depth or len(rows) < 2:
            return at
        best = (1e-6, -1, -1)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            own = bins[rows, f]
            gl = np.bincount(own, gradient[rows], len(cuts) + 1).cumsum()[:-1]
            hl = np.bincount(own, weight[rows], len(cuts) + 1).cumsum()[:-1]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(hl < least) | (h - hl < least)] = -np.inf
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] < 0:
            return at
        _, f, k = best
        lower = bins[rows, f] <= k
        feature[at], edge[at] = f, edges[f][k]
        left[at] = node(rows[lower], level + 1)
        right[at] = node(rows[~lower], level + 1)
        return at

    node(np.arange(len(x)), 0)
    return Tree(*map(np.array, (feature, edge, left, right, value)))


class Booster(NamedTuple):
    start: float
    rate: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of each row."""
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += self.rate * tree.predict(x)
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0, ridge: float = 1.0
) -> Booster:
    """Trees on the logistic loss by second-order gains over quantile bins; the same rows give the same trees.

    With one class alone, or no rows, there are no trees and every row gets the rate of that class.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Booster(start, rate, [])
    edges = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        cuts = (values[:-1] + values[1:]) / 2
        edges.append(cuts if len(cuts) < bins else np.unique(np.quantile(cuts, np.linspace(0, 1, bins))))
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    total, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = _grow(x, edges, binned, p - y, p * (1 - p), depth, least, ridge)
        grown.append(tree)
        total += rate * tree.predict(x)
    return Booster(start, rate, grown)


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least score at which the selected rows reach ``precision``; above every score, 1.01, where none does."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else 1.01
