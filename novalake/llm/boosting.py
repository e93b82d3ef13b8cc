"""Gradient-boosted trees for a bounded set of examples, on histograms of feature values."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes by number: children of i are 2i + 1 and 2i + 2; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(len(self.feature).bit_length() - 1):
            feature = self.feature[at]
            right = x[np.arange(len(x)), np.maximum(feature, 0)] > self.cut[at]
            at = np.where(feature < 0, at, 2 * at + 1 + right)
        return self.value[at]


@dataclass
class Boosted:
    base: float = 0.0
    rate: float = 0.2
    trees: list[Tree] = field(default_factory=list)
    slope: float = 1.0  # of the calibration, fitted to examples left out of the boosting
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += self.rate * tree.predict(x)
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def _grow(x, bins, cuts, gradient, hessian, depth, least, smooth) -> Tree:
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
    members = {0: np.arange(len(x))}
    for node in range(size):
        rows = members.pop(node, None)
        if rows is None:
            continue
        g, h = gradient[rows].sum(), hessian[rows].sum()
        tree.value[node] = -g / (h + smooth)
        if node >= size // 2 or len(rows) < 2 * least:
            continue
        best = (1e-6, -1, 0)
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            gs = np.cumsum(np.bincount(bins[rows, f], gradient[rows], len(edges) + 1))[:-1]
            hs = np.cumsum(np.bincount(bins[rows, f], hessian[rows], len(edges) + 1))[:-1]
            ns = np.cumsum(np.bincount(bins[rows, f], minlength=len(edges) + 1))[:-1]
            gain = gs**2 / (hs + smooth) + (g - gs) ** 2 / (h - hs + smooth) - g**2 / (h + smooth)
            gain[(ns < least) | (len(rows) - ns < least)] = -1
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], f, at)
        _, f, at = best
        if f >= 0:
            tree.feature[node], tree.cut[node] = f, cuts[f][at]
            right = bins[rows, f] > at
            members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return tree


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2,
        least: int = 5, smooth: float = 1.0, bins: int = 32) -> Boosted:
    """Logistic loss. A quarter of the examples, by their place, only calibrates the margins."""
    held = np.arange(len(y)) % 4 == 3
    train_x, train_y = x[~held], y[~held].astype(float)
    cuts = [np.unique(np.quantile(train_x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    cuts = [c[c < train_x[:, f].max()] for f, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, train_x[:, f]) for f, c in enumerate(cuts)], axis=1)
    share = np.clip(train_y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), rate)
    margin = np.full(len(train_y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(train_x, binned, cuts, p - train_y, p * (1 - p), depth, least, smooth)
        model.trees.append(tree)
        margin += rate * tree.predict(train_x)
    _calibrate(model, x[held], y[held].astype(float))
    return model


def _calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> None:
    """Slope and shift by Newton steps; targets are drawn in a little, as for few examples."""
    if len(y) < 20 or y.min() == y.max():
        return
    margin = model.margin(x)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    design = np.stack((margin, np.ones(len(y))), axis=1)
    weights = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        weights -= np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * (weights - [1.0, 0.0]))
    model.slope, model.shift = float(max(weights[0], 0.1)), float(weights[1])
