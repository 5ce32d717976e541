"""Moments of many columns that merge: counts, means, second moments and co-moments over the rows where both of a pair are there."""

from __future__ import annotations

import numpy as np


class Moments:
    """Of k columns: n[i, j] rows where both i and j are there, and over those mean[i, j] and second[i, j] of i and co[i, j]; the diagonal is a column's own.

    Parts merge by the differences of their means, so nothing is lost where values are large and vary little.
    low and high: least and largest values.
    """

    def __init__(self, n: np.ndarray, mean: np.ndarray, second: np.ndarray, co: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.mean, self.second, self.co, self.low, self.high = n, mean, second, co, low, high

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """Of rows x columns; NaN is missing."""
        there = ~np.isnan(x)
        count = there.sum(axis=0)
        centre = np.where(count > 0, np.where(there, x, 0.0).sum(axis=0) / np.maximum(count, 1), 0.0)
        y, m = np.where(there, x - centre, 0.0), there.astype(float)
        n, s = m.T @ m, y.T @ m
        rows = np.maximum(n, 1.0)
        low, high = (np.where(count > 0, f(np.where(there, x, z), axis=0, initial=z), np.nan) for f, z in ((np.min, np.inf), (np.max, -np.inf)))
        square = (y * y).T @ m
        second = square - s * s / rows
        second[second <= 1e-13 * square] = 0.0  # what rounding leaves of a constant
        return cls(n, np.where(n > 0, centre[:, None] + s / rows, 0.0), second, y.T @ y - s * s.T / rows, low, high)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        step, weight = other.mean - self.mean, self.n * other.n / np.maximum(n, 1.0)
        mean = self.mean + step * other.n / np.maximum(n, 1.0)
        return Moments(n, mean, self.second + other.second + step * step * weight, self.co + other.co + step * step.T * weight, np.fmin(self.low, other.low), np.fmax(self.high, other.high))

    def correlations(self) -> np.ndarray:
        """k x k; NaN where fewer than two rows have both or one doesn't vary over them."""
        size = np.maximum(self.second + self.n * self.mean * self.mean, 1e-300)
        varies = (self.n > 1) & (self.second > 1e-19 * size)
        second = np.where(varies, self.second, np.nan)
        return self.co / np.sqrt(second * second.T)

    def to_bytes(self) -> bytes:
        k = len(self.low)
        upper = np.triu_indices(k)
        return np.concatenate([self.n[upper], self.co[upper], self.mean.ravel(), self.second.ravel(), self.low, self.high]).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, k: int) -> Moments:
        values, upper, half = np.frombuffer(data, "<f8"), np.triu_indices(k), k * (k + 1) // 2
        whole = []
        for part in (values[:half], values[half : 2 * half]):
            x = np.zeros((k, k))
            x[upper] = part
            whole.append(x + np.triu(x, 1).T)
        mean, second = values[2 * half : 2 * half + 2 * k * k].reshape(2, k, k)
        low, high = values[2 * half + 2 * k * k :].reshape(2, k)
        return cls(whole[0], mean, second, whole[1], low, high)
