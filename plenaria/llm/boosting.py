"""Gradient-boosted trees over histograms, kept as flat arrays for traversal by numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS, TREES, DEPTH, RATE, SHRINK, LEAST_WEIGHT = 64, 80, 4, 0.15, 1.0, 5.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Trees:
    """All trees' nodes in a row: feature, threshold, children and value; a leaf is its own child."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row; all rows and trees go down one level at a time."""
        if not len(self.roots):
            return np.full(len(x), float(sigmoid(np.array(self.base))))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[rows, self.feature[node]] > self.threshold[node], self.right[node], self.left[node])
        return sigmoid(self.base + self.value[node].sum(axis=1))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for a log loss; without rows or with one class only, the smoothed share of class 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    base, nodes, roots = float(np.log(share / (1 - share))), [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.column_stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)])
        margin = np.full(len(y), base)
        for _ in range(TREES):
            p = sigmoid(margin)
            roots.append(len(nodes))
            margin += _grow(nodes, binned, edges, y - p, p * (1 - p))
    column = lambda i, kind: np.array([n[i] for n in nodes], kind)
    return Trees(base, np.array(roots, np.int64), column(0, np.int64), column(1, float), column(2, np.int64), column(3, np.int64), column(4, float))


def _grow(nodes: list[list], binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Add one tree's nodes, level by level; the change of each row's margin."""
    rows, features = binned.shape
    change, first = np.zeros(rows), len(nodes)
    nodes.append([0, np.inf, first, first, 0.0])
    level = [(first, np.arange(rows))]
    for depth in range(DEPTH + 1):
        after = []
        for at, own in level:
            g, h = gradient[own], weight[own]
            best = (1e-6, 0, 0)
            if depth < DEPTH and h.sum() >= 2 * LEAST_WEIGHT:
                place = (binned[own] + np.arange(features) * BINS).ravel()
                sums, weights = (np.bincount(place, np.repeat(v, features), features * BINS).reshape(features, BINS).cumsum(axis=1) for v in (g, h))
                rest, others = g.sum() - sums, h.sum() - weights
                gain = sums**2 / (weights + SHRINK) + rest**2 / (others + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
                gain[(weights < LEAST_WEIGHT) | (others < LEAST_WEIGHT)] = 0
                f, b = divmod(int(gain.argmax()), BINS)
                best = max(best, (float(gain[f, b]), f, b))
            if best[0] > 1e-6:
                _, f, b = best
                goes = binned[own, f] > b
                left, right = len(nodes), len(nodes) + 1
                nodes[at][:4] = [f, float(edges[f][b]), left, right]
                nodes += [[0, np.inf, left, left, 0.0], [0, np.inf, right, right, 0.0]]
                after += [(left, own[~goes]), (right, own[goes])]
            else:
                nodes[at][4] = RATE * float(g.sum() / (h.sum() + SHRINK))
                change[own] = nodes[at][4]
        level = after
    return change
