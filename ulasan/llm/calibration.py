"""Platt scaling of a raw score on a bounded set of rows."""

from __future__ import annotations

import numpy as np


def logit(p: np.ndarray, edge: float = 1e-6) -> np.ndarray:
    p = np.clip(p, edge, 1 - edge)
    return np.log(p / (1 - p))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def platt(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[float, float]:
    """Slope (never negative) and intercept of a logistic curve, by Newton steps."""
    a, b = 0.0, float(logit(np.array([(y.sum() + 1) / (len(y) + 2)]))[0])
    if not len(x) or y.min() == y.max():
        return 0.0, b
    for _ in range(rounds):
        p = sigmoid(a * x + b)
        g = np.array([((p - y) * x).sum() + ridge * a, (p - y).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        size = max(1.0, float(np.abs(step).max()) / 2.0)
        a, b = a - step[0] / size, b - step[1] / size
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(a)), float(b)
