"""Gradient-boosted trees in numpy: log loss, histogram splits, full binary
trees of a fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 4
_BINS = 32


@dataclass
class Trees:
    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 50, rate: float = 0.3, ridge: float = 2.0) -> Trees:
    weight = np.ones(len(y)) if weight is None else weight
    p = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    n_f, inner = x.shape[1], (1 << DEPTH) - 1
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, _BINS + 1)[1:-1])) for f in range(n_f)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)  # <= cut goes left
    flat = binned + np.arange(n_f) * _BINS
    score = np.full(len(y), base)
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        q = 1 / (1 + np.exp(-score))
        g, h = weight * (y - q), weight * q * (1 - q) + 1e-9
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            if len(own) >= 8:
                at = flat[own].ravel()
                gs = np.bincount(at, np.repeat(g[own], n_f), n_f * _BINS).reshape(n_f, _BINS).cumsum(axis=1)
                hs = np.bincount(at, np.repeat(h[own], n_f), n_f * _BINS).reshape(n_f, _BINS).cumsum(axis=1)
                total_g, total_h = gs[0, -1], hs[0, -1]
                gain = gs ** 2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - total_g ** 2 / (total_h + ridge)
                for f, c in enumerate(cuts):
                    gain[f, len(c):] = 0
                f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[f, b] > 1e-6:
                    out.feature[t, k], out.threshold[t, k] = f, cuts[f][b]
            node[own] = 2 * k + 1 + (x[own, out.feature[t, k]] > out.threshold[t, k])
        leaf = node - inner
        out.leaf[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        score += out.leaf[t][leaf]
    return out
