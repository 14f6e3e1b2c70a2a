"""A small decision tree: grown on a bounded labelled table, applied to numpy batches on the executors."""

from __future__ import annotations

import numpy as np


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 20) -> tuple:
    """Nested (feature, threshold, left, right) with leaf probabilities; Gini impurity, ties to the first feature."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return (share,)
    best = (1e-9, -1, 0.0)
    base = share * (1 - share)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        left = np.cumsum(t)
        n = np.arange(1, len(t) + 1)
        cut = np.flatnonzero(v[1:] > v[:-1])
        cut = cut[(n[cut] >= least) & (len(t) - n[cut] >= least)]
        if not len(cut):
            continue
        nl, nr = n[cut], len(t) - n[cut]
        pl, pr = left[cut] / nl, (left[-1] - left[cut]) / nr
        gain = base - (nl * pl * (1 - pl) + nr * pr * (1 - pr)) / len(t)
        k = int(np.argmax(gain))
        if gain[k] > best[0] + 1e-12:
            best = (float(gain[k]), f, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    _, f, threshold = best
    if f < 0:
        return (share,)
    side = x[:, f] <= threshold
    return (f, threshold, grow(x[side], y[side], depth - 1, least), grow(x[~side], y[~side], depth - 1, least))


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))

    def walk(node: tuple, rows: np.ndarray) -> None:
        if len(node) == 1:
            out[rows] = node[0]
            return
        f, threshold, left, right = node
        side = x[rows, f] <= threshold
        walk(left, rows[side])
        walk(right, rows[~side])

    walk(tree, np.arange(len(x)))
    return out
