"""Logistic regression on the driver, for samples of bounded size."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Intercept and coefficients by Newton's method with a ridge on the coefficients.

    Without rows, or with one label only, the coefficients are 0 and the intercept follows the labels.
    """
    n, k = x.shape
    weight = np.ones(n) if weight is None else weight
    share = (weight @ y + 0.5) / (weight.sum() + 1.0)
    beta = np.zeros(k + 1)
    beta[0] = np.log(share / (1 - share))
    if not n or y.min() == y.max():
        return beta
    full = np.column_stack([np.ones(n), x])
    penalty = np.diag([1e-6] + [ridge] * k)
    for _ in range(rounds):
        p = sigmoid(full @ beta)
        slope = full.T @ (weight * (y - p)) - penalty @ beta
        bend = (full * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ full + penalty
        step = np.linalg.solve(bend, slope)
        size = np.abs(step).max()
        beta += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return beta
