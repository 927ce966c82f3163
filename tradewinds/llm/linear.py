"""Linear models over sparse rows, fitted on a bounded sample and applied inside tasks."""

from __future__ import annotations

import numpy as np


def hinge_by_dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, size: int,
                          costs: np.ndarray, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Weights of the linear model with the least hinge loss plus half its squared length.

    Dual coordinate descent: each step solves one example's dual variable exactly, within
    [0, cost], and keeps the weights up to date. `rows` holds feature numbers, `values` their
    values, `signs` +1 or -1.
    """
    weights, alphas = np.zeros(size), np.zeros(len(rows))
    lengths = np.array([v @ v for v in values])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            if lengths[i] == 0:
                continue
            gradient = signs[i] * (weights[rows[i]] @ values[i]) - 1
            new = min(max(alphas[i] - gradient / lengths[i], 0.0), costs[i])
            step = new - alphas[i]
            if step:
                weights[rows[i]] += step * signs[i] * values[i]
                alphas[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrated(margins: np.ndarray, labels: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset that make sigmoid(slope * margin + offset) fit the labels (0 to 1), by damped Newton steps.

    Labels are drawn in from 0 and 1 as Platt proposes, so separable margins keep a finite slope.
    """
    high, low = (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2)
    target = low + (high - low) * labels
    x = np.stack([margins, np.ones(len(margins))], 1)
    fit = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ fit)
        slope = x.T @ (p - target) + 1e-6 * fit
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        fit -= step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
    return float(fit[0]), float(fit[1])
