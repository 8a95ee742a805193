"""Linear models on small, bounded training samples: squared-hinge linear SVM and softmax regression, in numpy."""

from __future__ import annotations

import numpy as np


def _descend(x: np.ndarray, loss_gradient, weights: np.ndarray, l2: float, smooth: float, steps: int) -> np.ndarray:
    """Nesterov's accelerated gradient descent with a step of 1 / (Lipschitz bound)."""
    vector = np.random.default_rng(0).normal(size=x.shape[1]).astype(x.dtype)
    for _ in range(15):
        vector = x.T @ (x @ vector)
        norm = float(np.linalg.norm(vector)) or 1.0
        vector /= norm
    rate = 1.0 / (smooth * norm / len(x) * 1.1 + l2)
    ahead, t = weights.copy(), 1.0
    for _ in range(steps):
        following = ahead - rate * (x.T @ loss_gradient(x @ ahead) / len(x) + l2 * ahead)
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = following + (t - 1) / t_next * (following - weights)
        weights, t = following, t_next
    return weights


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss; y is +1 or -1, the classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)).astype(x.dtype)
    y = y.astype(x.dtype)
    return _descend(x, lambda m: -2 * weight * y * np.maximum(0, 1 - y * m), np.zeros(x.shape[1], x.dtype), l2, 2 * float(weight.max()), steps)


def fit_weighted_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss; every row counts by its weight (1 on the average)."""
    some = weight > 0
    y, root = y[some].astype(x.dtype), np.sqrt(weight[some]).astype(x.dtype)
    return _descend(x[some] * root[:, None], lambda m: -2 * root * y * np.maximum(0, 1 - y * m / root), np.zeros(x.shape[1], x.dtype), l2, 2.0, steps)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, l2: float = 1e-4, steps: int = 200) -> np.ndarray:
    """(features, classes) weights of softmax regression; y holds class numbers."""
    target = np.eye(classes, dtype=x.dtype)[y]
    return _descend(x, lambda m: softmax(m) - target, np.zeros((x.shape[1], classes), x.dtype), l2, 0.5, steps)


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_sigmoid(margins: np.ndarray, y: np.ndarray, steps: int = 100) -> float:
    """Positive slope s so that 1 / (1 + exp(-s * margin)) fits the labels (+1 / -1) by Newton's method."""
    s, m = 1.0, margins * y
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(s * m, -60, 60)))
        change = ((p * m).mean() - 1e-3 * s) / ((p * (1 - p) * m * m).mean() + 1e-3)
        s = max(1e-3, s + float(np.clip(change, -1, 1)))
    return s
