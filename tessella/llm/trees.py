"""Gradient-boosted trees with monotone constraints, grown on binned features and flattened into node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of shape (trees, nodes).  A leaf points to itself, so `depth` steps reach it from the root."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[t][node]] <= self.threshold[t][node]
                node = np.where(goes_left, self.left[t][node], self.right[t][node])
            total += self.value[t][node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _leaf(g: float, h: float, low: float, high: float, ridge: float) -> float:
    return float(np.clip(-g / (h + ridge), low, high))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Forest:
    """`monotone[f]`: 1 if the score may only rise with feature f, -1 if it may only fall, 0 if it is free.

    A split on a constrained feature is taken only if its children's values stand in that order, and bounds
    half-way between them hold for everything below, so the whole sum is monotone.  No rows or one class
    gives a forest without splits.
    """
    n, features = x.shape
    size = 2 ** (depth + 1) - 1
    empty = np.zeros((0, size))
    rate_of = float(y.mean()) if n else 0.5
    base = float(np.log((rate_of * n + 1) / ((1 - rate_of) * n + 1)))
    if n == 0 or rate_of in (0.0, 1.0):
        return Forest(empty.astype(int), empty, empty.astype(int), empty.astype(int), empty, base, depth)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(features)], 1)
    margin = np.full(n, base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(size, int), np.zeros(size)
        left, right, value = np.arange(size), np.arange(size), np.zeros(size)
        where = np.zeros(n, int)
        todo = [(0, 0, -np.inf, np.inf)]
        while todo:
            node, level, low, high = todo.pop()
            rows = np.flatnonzero(where == node)
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = rate * _leaf(gs, hs, low, high, ridge)
            if level == depth or hs < 2 * least:
                continue
            best = (1e-6, None)
            for f in range(features):
                if not len(cuts[f]):
                    continue
                width = len(cuts[f]) + 1
                lg = np.cumsum(np.bincount(binned[rows, f], g[rows], width))[:-1]
                lh = np.cumsum(np.bincount(binned[rows, f], h[rows], width))[:-1]
                wl = np.clip(-lg / (lh + ridge), low, high)
                wr = np.clip(-(gs - lg) / (hs - lh + ridge), low, high)
                gain = -(lg * wl + 0.5 * (lh + ridge) * wl**2) - ((gs - lg) * wr + 0.5 * (hs - lh + ridge) * wr**2)
                own = np.clip(-gs / (hs + ridge), low, high)
                gain += gs * own + 0.5 * (hs + ridge) * own**2
                allowed = (lh >= least) & (hs - lh >= least) & (monotone[f] * (wr - wl) >= 0)
                gain = np.where(allowed, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, wl[k], wr[k]))
            if best[1] is None:
                continue
            f, k, wl, wr = best[1]
            feature[node], threshold[node] = f, cuts[f][k]
            left[node], right[node] = 2 * node + 1, 2 * node + 2
            goes = binned[rows, f] <= k
            where[rows[goes]], where[rows[~goes]] = 2 * node + 1, 2 * node + 2
            middle = (wl + wr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[monotone[f]]
            todo += [(2 * node + 1, level + 1, *bounds[0]), (2 * node + 2, level + 1, *bounds[1])]
        made.append((feature, threshold, left, right, value))
        margin += value[where]
    stacked = [np.stack(part) for part in zip(*made)]
    return Forest(*stacked, base, depth)
