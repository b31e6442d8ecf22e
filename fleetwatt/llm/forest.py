"""A random forest of binary decisions in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = -1


@dataclass
class Forest:
    """Per tree the feature, threshold, children and share of positives of each node."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of positives over the trees, for each row of ``x``."""
        total = np.zeros(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            while True:
                feature = self.feature[t][node]
                inner = np.flatnonzero(feature != LEAF)
                if not len(inner):
                    break
                at = node[inner]
                down = x[inner, feature[inner]] <= self.threshold[t][at]
                node[inner] = np.where(down, self.left[t][at], self.right[t][at])
            total += self.share[t][node]
        return total / max(1, len(self.feature))


def gini_cut(x: np.ndarray, y: np.ndarray, cuts: int) -> tuple[float, float]:
    """The best of ``cuts`` quantile thresholds of one feature: impurity after it, and where."""
    values = np.unique(np.quantile(x, np.linspace(0, 1, cuts + 2)[1:-1], method="lower"))
    if len(values) < 1:
        return np.inf, 0.0
    below = x[:, None] <= values
    n = below.sum(0)
    ones = (below & (y[:, None] > 0)).sum(0)
    rest, other = len(y) - n, y.sum() - ones
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = np.where(n > 0, ones * (n - ones) / n, 0) + np.where(rest > 0, other * (rest - other) / rest, 0)
    impurity = np.where((n == 0) | (rest == 0), np.inf, impurity)
    best = int(np.argmin(impurity))
    return float(impurity[best]), float(values[best])


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9, least: int = 3, cuts: int = 24, seed: int = 5) -> Forest:
    """Trees on bootstrap rows, each cut among the square root of the features. ``y`` is 0 or 1."""
    rng = np.random.default_rng(seed)
    tries = max(1, int(np.sqrt(x.shape[1])) + 1)
    grown = []
    for _ in range(trees):
        rows = rng.integers(0, len(x), len(x))
        nodes: list[list[float]] = [[LEAF, 0.0, 0, 0, float(y[rows].mean())]]
        open_ = [(0, rows, 0)]
        while open_:
            at, own, level = open_.pop()
            share = y[own].mean()
            if level >= depth or len(own) < 2 * least or share in (0.0, 1.0):
                continue
            found = min(
                ((*gini_cut(x[own, f], y[own], cuts), int(f)) for f in rng.choice(x.shape[1], tries, replace=False)), key=lambda c: c[0]
            )
            if not np.isfinite(found[0]):
                continue
            down = x[own, found[2]] <= found[1]
            parts = own[down], own[~down]
            if min(map(len, parts)) < least:
                continue
            nodes[at][:4] = [found[2], found[1], len(nodes), len(nodes) + 1]
            for part in parts:
                open_.append((len(nodes), part, level + 1))
                nodes.append([LEAF, 0.0, 0, 0, float(y[part].mean())])
        grown.append(np.array(nodes))
    width = max(map(len, grown))
    table = np.zeros((len(grown), width, 5))
    for t, nodes in enumerate(grown):
        table[t, : len(nodes)] = nodes
    return Forest(table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 2].astype(int), table[:, :, 3].astype(int), table[:, :, 4])
