"""Recursive indicators of one series, as numpy arrays.

Every recursion is y = (1 - a) y_before + a x from a seed; the nonlinear parts come after it.
Positions before the first value are NaN, which leaves for Spark as NULL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from ..schema import AVERAGES


def smoothed(x: np.ndarray, alpha: float, seed: float, first: int) -> np.ndarray:
    """From `seed` at position `first`, weighted by alpha with each later x."""
    out = np.full(len(x), np.nan)
    if first < len(x):
        out[first:] = pd.Series(np.concatenate([[seed], x[first + 1 :]])).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return out


def ema(x: np.ndarray, n: int, start: int = 0) -> np.ndarray:
    """Seeded with the mean of x[start : start + n]."""
    first = start + n - 1
    return smoothed(x, 2 / (n + 1), float(np.mean(x[start : start + n])) if first < len(x) else np.nan, first)


def wilder(x: np.ndarray, n: int) -> np.ndarray:
    """Seeded with the mean of x[1 : n + 1] at n; x[0] isn't defined."""
    return smoothed(x, 1 / n, float(np.mean(x[1 : n + 1])) if n < len(x) else np.nan, n)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 a / b; 0 where b is 0, NaN where it is."""
    return np.where(b == 0, 0.0, 100 * a / np.where(b == 0, 1.0, b))


def rsi(close: np.ndarray, n: int) -> np.ndarray:
    change = np.diff(close, prepend=np.nan)
    gain, loss = wilder(np.where(change > 0, change, 0.0), n), wilder(np.where(change < 0, -change, 0.0), n)
    return _share(gain, gain + loss)


def true_range(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
    before = np.concatenate([[np.nan], close[:-1]])
    return np.maximum(high - low, np.maximum(np.abs(high - before), np.abs(low - before)))


def macd(close: np.ndarray, fast: int = 12, slow: int = 26, signal: int = 9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, signal, difference), all from the signal's first value on; both averages start together."""
    line = ema(close, fast, slow - fast) - ema(close, slow)
    smooth = np.full(len(close), np.nan)
    if len(close) > slow - 1:
        smooth[slow - 1 :] = ema(line[slow - 1 :], signal)
    line = np.where(np.isnan(smooth), np.nan, line)
    return line, smooth, line - smooth


def directional(high: np.ndarray, low: np.ndarray, close: np.ndarray, n: int = 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(+DI, -DI, ADX) from Wilder sums seeded with the first n - 1 movements."""
    up, down = np.diff(high, prepend=np.nan), -np.diff(low, prepend=np.nan)
    plus, minus = np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)
    out = np.full(len(close), np.nan)
    if len(close) <= n:
        return out, out.copy(), out.copy()

    def total(x: np.ndarray) -> np.ndarray:
        sums = smoothed(x * n, 1 / n, float(np.sum(x[1:n])), n - 1)
        sums[n - 1] = np.nan
        return sums

    ranges = total(true_range(high, low, close))
    plus_di, minus_di = _share(total(plus), ranges), _share(total(minus), ranges)
    dx = _share(np.abs(plus_di - minus_di), plus_di + minus_di)
    if len(close) >= 2 * n:
        out = smoothed(dx, 1 / n, float(np.mean(dx[n : 2 * n])), 2 * n - 1)
    return plus_di, minus_di, out


def recursive_columns(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of schema.RECURSIVE for a series in order of time."""
    line, signal, difference = macd(close)
    fast, slow = ema(close, 12), ema(close, 26)
    plus, minus, adx = directional(high, low, close)
    ranges = true_range(high, low, close)
    momentum = np.where(slow > 0, (fast - slow) / np.where(slow > 0, slow, 1.0), np.nan)
    return {f"ema_{n}": ema(close, n) for n in AVERAGES} | {
        "macd": line, "macd_signal": signal, "macd_hist": difference, "momentum_score": momentum,
        "rsi_14": rsi(close, 14), "rsi_21": rsi(close, 21), "atr_14": wilder(ranges, 14), "atr_21": wilder(ranges, 21),
        "plus_di": plus, "minus_di": minus, "adx_14": adx,
    }
