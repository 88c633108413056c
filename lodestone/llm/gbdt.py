"""Histogram gradient-boosted trees in numpy, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``cut``: (trees, 2**depth - 1), complete trees in level order; ``leaf``: (trees, 2**depth)."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that the rows reach, all trees of a block of rows at once."""
        out = np.empty(len(x))
        trees = np.arange(len(self.leaf))
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            at = np.zeros((len(part), len(trees)), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (part[rows, self.feature[trees, at]] > self.cut[trees, at])
            out[a : a + 4096] = self.base + self.leaf[trees, at - (2**self.depth - 1)].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 2.0) -> Trees:
    """Logistic loss, second-order gains on quantile bins. One class only: a constant."""
    n, d = x.shape
    weight = np.ones(n) if weight is None else weight
    mean = float(np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)) if n else 0.5
    base, inner = float(np.log(mean / (1 - mean))), 2**depth - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if n == 0 or y.min() == y.max():
        return Trees(feature[:1], cut[:1], leaf[:1], base, depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    offset = np.arange(d) * bins
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            key = ((at - first)[:, None] * (d * bins) + offset + binned).ravel()
            gs = np.bincount(key, np.repeat(g, d), nodes * d * bins).reshape(nodes, d, bins).cumsum(axis=2)
            hs = np.bincount(key, np.repeat(h, d), nodes * d * bins).reshape(nodes, d, bins).cumsum(axis=2)
            gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
            gain[(hs < 1) | (ht - hs < 1)] = -1
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[t, first + k], cut[t, first + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > cut[t, at])
        slot = at - inner
        leaf[t] = -rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + ridge)
        margin += leaf[t, slot]
    return Trees(feature, cut, leaf, base, depth)
