"""A random forest of binary classification trees in numpy."""

from __future__ import annotations

import numpy as np


class Forest:
    """Trees on bootstrap samples, each split the best of a random subset of features by Gini impurity."""

    def __init__(self, trees: int = 40, depth: int = 12, least: int = 2, seed: int = 1):
        self.trees, self.depth, self.least, self.seed = trees, depth, least, seed
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.trees):
            rows = rng.integers(0, len(x), len(x))
            self.nodes.append(self._grow(x[rows], y[rows].astype(np.float64), rng))
        return self

    def _grow(self, x, y, rng):
        feature, cut, child, value = [], [], [], []
        tries = max(1, round(x.shape[1] ** 0.5))
        todo = [(np.arange(len(y)), 0, -1, 0)]
        while todo:
            rows, depth, parent, side = todo.pop()
            at = len(feature)
            if parent >= 0:
                child[parent][side] = at
            feature.append(-1), cut.append(0.0), child.append([-1, -1]), value.append(y[rows].mean())
            if depth == self.depth or len(rows) < 2 * self.least or value[-1] in (0.0, 1.0):
                continue
            best = (0.0, -1, 0.0)
            for f in rng.choice(x.shape[1], tries, replace=False):
                if (gain := self._split(x[rows, f], y[rows]))[0] > best[0] + 1e-12:
                    best = (gain[0], f, gain[1])
            if best[1] < 0:
                continue
            feature[at], cut[at] = best[1], best[2]
            left = x[rows, best[1]] <= best[2]
            todo += [(rows[left], depth + 1, at, 0), (rows[~left], depth + 1, at, 1)]
        return np.array(feature), np.array(cut), np.array(child), np.array(value)

    def _split(self, v, y):
        order = np.argsort(v, kind="stable")
        v, y = v[order], y[order]
        n, ones = np.arange(1, len(y)), np.cumsum(y)[:-1]
        rest, total = len(y) - n, y.sum()
        ok = (v[1:] > v[:-1]) & (n >= self.least) & (rest >= self.least)
        if not ok.any():
            return 0.0, 0.0
        score = ones**2 / n + (n - ones) ** 2 / n + (total - ones) ** 2 / rest + (rest - total + ones) ** 2 / rest
        score = np.where(ok, score, -1.0)
        k = int(np.argmax(score))
        return score[k] - (total**2 + (len(y) - total) ** 2) / len(y), (v[k] + v[k + 1]) / 2

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of positives in the leaves."""
        out = np.zeros(len(x))
        for feature, cut, child, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            while (inner := np.flatnonzero(feature[at] >= 0)).size:
                a = at[inner]
                at[inner] = child[a, (x[inner, feature[a]] > cut[a]).astype(np.int64)]
            out += value[at]
        return out / max(1, len(self.nodes))
