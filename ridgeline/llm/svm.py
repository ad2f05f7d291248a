"""Linear support vector machine on sparse rows, by dual coordinate descent, and its calibration."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: column numbers and values of row i lie at ``at[i]:at[i + 1]``."""

    def __init__(self, at: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.at, self.column, self.value = at, column, value

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.at)[rows]
        at = np.concatenate(([0], np.cumsum(size)))
        flat = np.repeat(self.at[rows] - at[:-1], size) + np.arange(at[-1])
        return Rows(at, self.column[flat], self.value[flat])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Row sums of ``weights[column] * value``."""
        total = np.concatenate(([0.0], np.cumsum(weights[self.column] * self.value, dtype=np.float64)))
        return total[self.at[1:]] - total[self.at[:-1]]


def hinge_svm(rows: Rows, label: np.ndarray, columns: int, cost: np.ndarray, epochs: int = 12, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) that minimise ``|w|**2 / 2 + sum(cost * hinge loss)``.

    ``label`` is +1 or -1.  One dual variable per row is optimised at a time, in a new random
    order each epoch, between 0 and the row's cost.
    """
    weights, dual = np.zeros(columns + 1), np.zeros(len(rows))
    total = np.concatenate(([0.0], np.cumsum(rows.value ** 2, dtype=np.float64)))
    square = total[rows.at[1:]] - total[rows.at[:-1]] + 1.0
    order, at = np.random.default_rng(seed), rows.at.tolist()
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)).tolist():
            column, value, y = rows.column[at[i]:at[i + 1]], rows.value[at[i]:at[i + 1]], label[i]
            slope = y * (weights[column] @ value + weights[-1]) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), cost[i])
            step = (new - dual[i]) * y
            if step:
                dual[i] = new
                weights[column] += step * value
                weights[-1] += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """``a, b`` such that ``1 / (1 + exp(-(a * margin + b)))`` fits the labels (+1, -1) by Newton steps."""
    up, down = weight[label > 0].sum(), weight[label < 0].sum()
    target = np.where(label > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hessian, np.array([(g * margin).sum() + 1e-6 * a, g.sum()]))
        step /= max(1.0, np.abs(step).max())
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 1e-3), b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
