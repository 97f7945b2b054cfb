"""Gradient-boosted trees with logistic loss, and isotonic calibration, in numpy.

Fitted on the driver on a bounded number of rows of a few numbers each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A complete binary tree; node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    depth: int

    def value(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.limit[node])
        return self.leaf[node - len(self.feature)]


@dataclass
class Boosted:
    start: float
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.value(x)
        return out


def _grow(bins, edges, grad, hess, depth, penalty, least) -> tuple[Tree, np.ndarray]:
    n, width = bins.shape
    inner = 2 ** depth - 1
    feature, limit, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
    node = np.zeros(n, np.int64)
    for i in range(inner):
        at = np.flatnonzero(node == i)
        best, choice = 1e-9, None
        if len(at) >= 2 * least:
            g, h = grad[at], hess[at]
            whole = g.sum() ** 2 / (h.sum() + penalty)
            for f in range(width):
                k = len(edges[f]) + 1
                if k < 2:
                    continue
                b = bins[at, f]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, k))[:-1] for w in (g, h, None))
                gain = gl ** 2 / (hl + penalty) + (g.sum() - gl) ** 2 / (h.sum() - hl + penalty) - whole
                gain[(nl < least) | (len(at) - nl < least)] = 0
                j = int(gain.argmax())
                if gain[j] > best:
                    best, choice = gain[j], (f, j)
        if choice:
            feature[i], limit[i] = choice[0], edges[choice[0]][choice[1]]
            node[at] = 2 * i + 1 + (bins[at, choice[0]] > choice[1])
        else:
            node[at] = 2 * i + 1
    for k in range(inner + 1):
        at = node == inner + k
        leaf[k] = -grad[at].sum() / (hess[at].sum() + penalty)
    return Tree(feature, limit, leaf, depth), leaf[node - inner]


def boost(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.1, bins: int = 32, penalty: float = 1.0, least: int = 8) -> Boosted:
    """Second-order boosting on quantile bins; without both labels only the smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T, strict=True)]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    raw = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        tree, step = _grow(binned, edges, p - y, p * (1 - p), depth, penalty, least)
        tree.leaf *= rate
        raw += rate * step
        model.trees.append(tree)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; scores and rising values between which to interpolate."""
    if not len(score):
        return np.zeros(1), np.zeros(1)
    at, inverse = np.unique(score, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    mean = np.bincount(inverse, y) / weight
    pools: list[list[float]] = []  # value, weight, number of points
    for v, w in zip(mean, weight, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return at, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])
