"""Small decision trees over tables of numbers, trained where they are used and kept as nested tuples."""

from __future__ import annotations

import numpy as np

# A leaf is a float; a split is (feature, threshold, tree for <=, tree for >).
Tree = float | tuple


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, least: float = 1.0, leaf=None) -> Tree:
    """Splits that lower the weighted squared error most (for 0/1 values that is the Gini impurity).

    Ties go to the first feature and the lowest threshold, so equal tables give equal trees.
    """
    leaf = leaf or (lambda rows: float(np.average(y[rows], weights=weight[rows])))

    def build(rows: np.ndarray, left: int) -> Tree:
        best = None
        if left and len(rows) > 1 and np.ptp(y[rows]) > 0:
            w, t = weight[rows], y[rows]
            for feature in range(x.shape[1]):
                order = np.argsort(x[rows, feature], kind="stable")
                value = x[rows, feature][order]
                below, sums = np.cumsum(w[order]), np.cumsum((w * t)[order])
                cuts = np.flatnonzero(value[1:] > value[:-1])
                cuts = cuts[(below[cuts] >= least) & (below[-1] - below[cuts] >= least)]
                if not len(cuts):
                    continue
                gain = sums[cuts] ** 2 / below[cuts] + (sums[-1] - sums[cuts]) ** 2 / (below[-1] - below[cuts])
                top = int(np.argmax(gain))
                gained = float(gain[top] - sums[-1] ** 2 / below[-1])
                if gained > 1e-9 and (best is None or gained > best[0] + 1e-12):
                    cut = cuts[top]
                    best = gained, feature, float((value[cut] + value[cut + 1]) / 2)
        if best is None:
            return leaf(rows)
        _, feature, threshold = best
        low = x[rows, feature] <= threshold
        return feature, threshold, build(rows[low], left - 1), build(rows[~low], left - 1)

    return build(np.arange(len(y)), depth)


def value_of(tree: Tree, row) -> float:
    while isinstance(tree, tuple):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return tree
