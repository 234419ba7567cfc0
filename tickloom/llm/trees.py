"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class Booster:
    """Complete trees of a fixed depth over quantile bins, fitted to the logistic loss."""

    def __init__(self, n_trees: int = 40, depth: int = 4, rate: float = 0.25, smoothing: float = 4.0):
        self.n_trees, self.depth, self.rate, self.smoothing = n_trees, depth, rate, smoothing
        self.cuts: list[np.ndarray] = []
        self.features = np.zeros((0, 0), np.int64)  # of the inner nodes of each tree
        self.limits = np.zeros((0, 0), np.int64)  # rows in a bin above the limit go right
        self.values = np.zeros((0, 0))
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)], axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(col, shares, method="lower")) for col in x.T]
        bins = self._binned(x)
        n, f = bins.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        raw, inner = np.full(n, self.base), (1 << self.depth) - 1
        features, limits, values = [], [], []
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            at = np.zeros(n, np.int64)
            tree_f, tree_l = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                place = at - first
                best = np.full(width, 1e-9)
                for k in range(f):
                    cell = place * BINS + bins[:, k]
                    gs = np.bincount(cell, g, width * BINS).reshape(width, BINS)
                    hs = np.bincount(cell, h, width * BINS).reshape(width, BINS)
                    gl, hl = gs.cumsum(axis=1), hs.cumsum(axis=1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    s = self.smoothing
                    gain = gl**2 / (hl + s) + (gt - gl) ** 2 / (ht - hl + s) - gt**2 / (ht + s)
                    cut = gain.argmax(axis=1)
                    own = gain[np.arange(width), cut]
                    better = np.flatnonzero(own > best)
                    best[better] = own[better]
                    tree_f[first + better], tree_l[first + better] = k, cut[better]
                at = 2 * at + 1 + (bins[np.arange(n), tree_f[at]] > tree_l[at])
            leaf = at - inner
            gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
            value = self.rate * gs / (hs + self.smoothing)
            raw += value[leaf]
            features.append(tree_f)
            limits.append(tree_l)
            values.append(value)
        self.features, self.limits, self.values = np.array(features), np.array(limits), np.array(values)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        bins, rows = self._binned(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        inner = (1 << self.depth) - 1
        for f, limit, value in zip(self.features, self.limits, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (bins[rows, f[at]] > limit[at])
            out += value[at - inner]
        return out
