"""Logistic regression by follow-the-regularised-leader updates, for sparse rows and one or more outputs."""

from __future__ import annotations

import numpy as np

Row = tuple[np.ndarray, np.ndarray]


class Ftrl:
    """FTRL-proximal with a rate for each coordinate. One output means a sigmoid, several mean a softmax. l1 and l2
    together are the elastic-net penalty; l1 keeps weights at exactly zero until their gradients speak up."""

    def __init__(self, size: int, outputs: int = 1, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        self.z = np.zeros((size + 1, outputs))  # the last row is the bias
        self.n = np.zeros((size + 1, outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, row: Row, label: int, weight: float = 1.0) -> None:
        at, x = np.append(row[0], len(self.z) - 1), np.append(row[1], 1.0)
        w = self.weights(at)
        p = probabilities(x @ w)
        y = np.array([float(label)]) if len(p) == 1 else np.eye(len(p))[label]
        g = np.outer(x, p - y) * weight
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def fitted(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights (size, outputs) and biases, as float32."""
        w = self.weights(slice(None)).astype(np.float32)
        return w[:-1], w[-1]


def probabilities(logits: np.ndarray) -> np.ndarray:
    if len(logits) == 1:
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
    e = np.exp(logits - logits.max())
    return e / e.sum()


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least negative log-likelihood, by golden-section search over its log."""

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(labels)), labels]).mean())

    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))
