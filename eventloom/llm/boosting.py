"""Gradient-boosted trees for a yes-or-no label, small enough to train on a driver and to keep as JSON."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Sums of regression trees of fixed depth over log-odds; node k has children 2k + 1 and 2k + 2."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.cut, self.leaf = base, feature, cut, leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out

    def to_dict(self) -> dict:
        return {"base": self.base, "feature": self.feature.tolist(), "cut": self.cut.tolist(), "leaf": np.round(self.leaf, 5).tolist()}

    @classmethod
    def from_dict(cls, d: dict) -> Boosted:
        return cls(d["base"], np.array(d["feature"], np.int64), np.array(d["cut"], np.float64), np.array(d["leaf"], np.float64))


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, damp: float = 2.0) -> Boosted:
    """Newton steps on the logistic loss; each split is the best over quantile bins of all features."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner = 2**depth - 1
    features, cuts, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = at - first
            best = np.zeros(width)
            for j in range(d):
                if not len(edges[j]):
                    continue
                cell = local * bins + code[:, j]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(axis=1)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(axis=1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + damp) + (total_g - gs) ** 2 / (total_h - hs + damp) - total_g**2 / (total_h + damp)
                gain = gain[:, : len(edges[j])]
                k = gain.argmax(axis=1)
                for w in np.flatnonzero(gain[np.arange(width), k] > best + 1e-6):
                    best[w] = gain[w, k[w]]
                    features[t, first + w], cuts[t, first + w] = j, edges[j][k[w]]
            at = 2 * at + 1 + (x[np.arange(n), features[t][at]] > cuts[t][at])
        place = at - inner
        leaves[t] = rate * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + damp)
        score += leaves[t][place]
    cuts[np.isinf(cuts)] = 1e300
    return Boosted(base, features, cuts, leaves)
