"""Follow-the-regularised-leader (proximal, per coordinate) over sparse rows."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """State of FTRL-proximal for ``dim`` weights.

    ``weights(i)`` gives the present weights of the coordinates ``i``;
    ``update(i, g, w)`` takes the gradient there (each coordinate once).
    """

    def __init__(self, dim: int, alpha: float = 2.0, beta: float = 0.1, l1: float = 0.02, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(dim), np.zeros(dim)

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, i: np.ndarray, g: np.ndarray, w: np.ndarray) -> None:
        n = self.n[i]
        grown = n + g * g
        self.z[i] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[i] = grown
