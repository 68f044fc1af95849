"""Boosted trees over distinct rows: Spark's GBTClassifier (logistic loss, variance trees), fitted inside one task.

Equal rows act as one with their count as its weight, so a fit costs the distinct rows, not all of
them, and no job per level of a tree.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

BINS, DEPTH, STEP = 32, 5, 0.1


def split_values(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Thresholds of a feature as Spark chooses them: between all values if they are few, else at equal counts."""
    values, at = np.unique(x, return_inverse=True)
    counts = np.bincount(at, weights=w)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < BINS:
        return middle
    done, stride, out = np.cumsum(counts), counts.sum() / BINS, []
    target = stride
    for i in range(1, len(values)):
        if abs(done[i - 1] - target) < abs(done[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def bins_of(x: np.ndarray, splits: list[np.ndarray]) -> np.ndarray:
    """Per feature the number of thresholds below a value; a missing value is above all."""
    return np.stack([np.searchsorted(s, x[:, f], side="left") for f, s in enumerate(splits)], axis=1)


def _tree(bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature or -1, last bin to the left, value) of the nodes, children of i at 2i + 1 and 2i + 2, and each row's node."""
    size = 2 ** (DEPTH + 1) - 1
    feature, last, value, node = np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size), np.zeros(len(y), np.int64)
    for level in range(DEPTH + 1):
        first, n = 2**level - 1, 2**level
        local = node - first
        here = local >= 0  # the others stand in leaves above
        moments = [w[here], (w * y)[here], (w * y * y)[here]]
        count, total, square = (np.bincount(local[here], weights=m, minlength=n) for m in moments)
        some = count > 0
        whole = np.where(some, count, 1)
        value[first : first + n] = total / whole
        impurity = np.where(some, square / whole - (total / whole) ** 2, 0.0)
        if level == DEPTH or not some.any():
            break
        best = np.zeros(n)
        for f in range(bins.shape[1]):
            key = local[here] * BINS + bins[here, f]
            c, s, q = (np.cumsum(np.bincount(key, weights=m, minlength=n * BINS).reshape(n, BINS), axis=1)[:, :-1] for m in moments)
            rest = count[:, None] - c
            valid = (c > 0.5) & (rest > 0.5)
            a, b = np.where(valid, c, 1), np.where(valid, rest, 1)
            # counts times variances of both sides
            inside = (q - s * s / a) + ((square[:, None] - q) - (total[:, None] - s) ** 2 / b)
            gain = np.where(valid, impurity[:, None] - inside / whole[:, None], 0.0)
            at = gain.argmax(axis=1)
            top = gain[np.arange(n), at]
            better = (top > best) & (impurity > np.finfo(float).eps)
            best = np.where(better, top, best)
            feature[first : first + n][better] = f
            last[first : first + n][better] = at[better]
        f = feature[node]
        goes = here & (f >= 0)
        right = bins[np.arange(len(y)), np.maximum(f, 0)] > last[node]
        node = np.where(goes, 2 * node + 1 + right, node)
    return feature, last, value, node


class BoostedTrees:
    def __init__(self, splits: list[np.ndarray], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.splits, self.trees = splits, trees

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of label 1, computed once for equal bins."""
        bins, back = np.unique(bins_of(x, self.splits), axis=0, return_inverse=True)
        margin, rows = np.zeros(len(bins)), np.arange(len(bins))
        for feature, last, value in self.trees:
            node = np.zeros(len(bins), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + 1 + (bins[rows, np.maximum(f, 0)] > last[node]), node)
            margin += value[node]
        return (1 / (1 + np.exp(-2 * margin)))[back.reshape(-1)]


def fit(x: np.ndarray, label: np.ndarray, w: np.ndarray, trees: int) -> BoostedTrees:
    """``label`` 0 or 1, ``w`` how often a row occurs."""
    splits = [split_values(x[:, f], w) for f in range(x.shape[1])]
    cells, at = np.unique(np.column_stack([bins_of(x, splits), label.astype(np.int64)]), axis=0, return_inverse=True)
    w = np.bincount(at.reshape(-1), weights=w)
    bins, y = cells[:, :-1], 2.0 * cells[:, -1] - 1
    margin, target, out = np.zeros(len(y)), y, []
    for i in range(trees):
        feature, last, value, node = _tree(bins, target, w)
        value = value if i == 0 else value * STEP
        margin = margin + value[node]
        target = 4 * y / (1 + np.exp(2 * y * margin))
        out.append((feature, last, value))
    return BoostedTrees(splits, out)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not hold the package
