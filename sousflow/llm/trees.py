"""Small decision trees for bounded labelled tables: one tree, or many boosted on the logistic loss.

Training tables here are built in code and hold a few thousand rows, so they are fitted on
the driver; the fitted arrays, a few kilobytes, go to the tasks that score the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has feature -1. Rows go left when their value is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            rows = np.flatnonzero(self.feature[at] >= 0)
            if not len(rows):
                return self.value[at]
            node = at[rows]
            low = x[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(low, self.left[node], self.right[node])


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, least: int, shrink: float) -> tuple[float, int, float]:
    total_g, total_h = g.sum(), h.sum()
    best = (1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, cg, ch = x[order, f], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        n = np.arange(1, len(v))
        gain = cg**2 / (ch + shrink) + (total_g - cg) ** 2 / (total_h - ch + shrink) - total_g**2 / (total_h + shrink)
        gain[(v[1:] == v[:-1]) | (n < least) | (len(v) - n < least)] = -1
        if len(gain) and gain.max() > best[0]:
            k = int(gain.argmax())
            best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
    return best


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: int = 2, shrink: float = 1e-6) -> Tree:
    """A tree that lowers the second-order loss with gradients ``g`` and curvatures ``h``."""
    nodes: list[list] = []

    def node(rows: np.ndarray, level: int) -> int:
        k = len(nodes)
        nodes.append([-1, 0.0, -1, -1, -g[rows].sum() / (h[rows].sum() + shrink)])
        if level < depth and len(rows) >= 2 * least:
            _, f, t = _best_split(x[rows], g[rows], h[rows], least, shrink)
            if f >= 0:
                low = x[rows, f] <= t
                left = node(rows[low], level + 1)
                nodes[k][:4] = f, t, left, node(rows[~low], level + 1)
        return k

    node(np.arange(len(x)), 0)
    f, t, left, right, value = zip(*nodes, strict=True)
    return Tree(np.array(f), np.array(t), np.array(left), np.array(right), np.array(value))


def classify(x: np.ndarray, y: np.ndarray, depth: int, least: int = 2) -> Tree:
    """A classification tree whose leaves hold the share of label 1 (squared loss, the Gini criterion)."""
    return grow(x, -y.astype(float), np.ones(len(y)), depth, least)


@dataclass(frozen=True)
class Boosted:
    """Boosted trees with a logistic calibration of their sum."""

    base: float
    trees: tuple[Tree, ...]
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(t.predict(x) for t in self.trees)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw(x) + self.shift))) if len(x) else np.zeros(0)


def boost(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float, least: int = 4) -> Boosted:
    """Gradient boosting on the logistic loss; every fifth row is held back to calibrate the probability."""
    held = np.arange(len(y)) % 5 == 4
    xs, ys = x[~held], y[~held].astype(float)
    base = float(np.log((ys.mean() + 1e-6) / (1 - ys.mean() + 1e-6)))
    score, trees = np.full(len(ys), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = grow(xs, p - ys, p * (1 - p) + 1e-9, depth, least, 1.0)
        tree = Tree(tree.feature, tree.threshold, tree.left, tree.right, tree.value * rate)
        score = score + tree.predict(xs)
        trees.append(tree)
    model = Boosted(base, tuple(trees))
    s, t = model.raw(x[held]), (y[held].sum() * y[held] + 1.0 * y[held] + (1 - y[held])) / (np.where(y[held] == 1, y[held].sum(), (1 - y[held]).sum()) + 2)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the two-parameter logistic fit on smoothed targets
        p = 1 / (1 + np.exp(-(a * s + b)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - t) * s).sum(), (p - t).sum()])
        hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
    return Boosted(base, tuple(trees), float(a), float(b))
