"""Gradient-boosted regression trees for a two-class loss, in numpy: small models, fast to fit and to ship."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Model(NamedTuple):
    """feature, bound: per tree, the inner nodes in breadth-first order; leaf: values; scale: Platt's slope and offset."""

    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray
    base: float
    scale: tuple[float, float]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0) -> Model:
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    p0 = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(p0 / (1 - p0)))
    score = np.full(n, base)
    feature = np.zeros((trees, 2**depth - 1), dtype=np.int32)
    bound = np.full((trees, 2**depth - 1), np.inf)
    leaf = np.zeros((trees, 2**depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for d in range(depth):
            wide = 2**d
            best = np.full(wide, 1e-9)
            pick = np.zeros(wide, dtype=np.int64)
            cut = np.full(wide, bins)
            for j in range(m):
                at = node * bins + code[:, j]
                gs = np.bincount(at, g, wide * bins).reshape(wide, bins).cumsum(1)
                hs = np.bincount(at, h, wide * bins).reshape(wide, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + least) + (gt - gs) ** 2 / (ht - hs + least) - gt**2 / (ht + least)
                k = gain.argmax(1)
                v = gain[np.arange(wide), k]
                up = v > best
                best[up], pick[up], cut[up] = v[up], j, k[up]
            for i in range(wide):
                e = edges[pick[i]]
                feature[t, wide - 1 + i] = pick[i]
                bound[t, wide - 1 + i] = e[cut[i]] if cut[i] < len(e) else np.inf
            right = code[np.arange(n), pick[node]] > cut[node]
            node = node * 2 + right
        gs, hs = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
        leaf[t] = rate * gs / (hs + least)
        score += leaf[t][node]
    return Model(feature, bound, leaf, base, (1.0, 0.0))


def raw(model: Model, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model.base)
    depth = int(np.log2(model.leaf.shape[1]))
    rows = np.arange(len(x))
    for f, b, leaf in zip(model.feature, model.bound, model.leaf):
        node = np.zeros(len(x), dtype=np.int64)
        for d in range(depth):
            at = 2**d - 1 + node
            node = node * 2 + (x[rows, f[at]] > b[at])
        score += leaf[node]
    return score


def calibrated(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Platt scaling on held-out rows, by Newton's method."""
    s = raw(model, x)
    a, b = 1.0, 0.0
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        d = p - target
        grad = np.array([(d * s).sum() + 1e-3 * (a - 1), d.sum() + 1e-3 * b])
        hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return model._replace(scale=(float(a), float(b)))


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    a, b = model.scale
    return 1 / (1 + np.exp(-np.clip(a * raw(model, x) + b, -30, 30)))
