"""Recursions that go on from where they stood.

Every recursion is y = (1 - a) y_before + a x, so n steps of it are one affine map
y = A y_start + B with A = (1 - a)^n; maps of neighbouring blocks compose.  A block's B is its
last value from a start of 0.  The first level runs over what bars give, the second (signal
line and ADX) over what the first level gives.  NaN stands for a value not yet seeded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from ..schema import AVERAGES
from .recursive import _share, ema, recursive_columns, smoothed, true_range, wilder

#: name: (what it runs over, weight of a new value, factor on it)
FIRST_LEVEL = (
    {f"ema_{n}": ("close", 2 / (n + 1), 1.0) for n in AVERAGES}
    | {"fast": ("close", 2 / 13, 1.0), "slow": ("close", 2 / 27, 1.0), "line_fast": ("close", 2 / 13, 1.0)}
    | {f"{x}_{n}": (x, 1 / n, 1.0) for n in (14, 21) for x in ("gain", "loss", "range")}
    | {f"sum_{x}": (x, 1 / 14, 14.0) for x in ("range", "plus", "minus")}
)
SECOND_LEVEL = {"signal": 0.2, "adx": 1 / 14}
#: Rows before which some recursion of a series isn't seeded.
SEEDED = max(AVERAGES)


def steps(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> dict[str, np.ndarray]:
    """What the first level runs over; the first row, which has none before it, has no changes."""
    change, up, down = np.diff(close, prepend=np.nan), np.diff(high, prepend=np.nan), -np.diff(low, prepend=np.nan)
    return {
        "close": close, "gain": np.where(change > 0, change, 0.0), "loss": np.where(change < 0, -change, 0.0), "range": true_range(high, low, close),
        "plus": np.where((up > down) & (up > 0), up, 0.0), "minus": np.where((down > up) & (down > 0), down, 0.0),
    }


def gone_on(x: np.ndarray, alpha: float, start: float) -> np.ndarray:
    """The recursion over x from the value before it."""
    return pd.Series(np.concatenate([[start], x])).ewm(alpha=alpha, adjust=False).mean().to_numpy()[1:]


def first_level(high: np.ndarray, low: np.ndarray, close: np.ndarray, skip: int = 0, start: np.ndarray | None = None) -> np.ndarray:
    """Values (recursion, row) of rows from skip on: seeded at the first row where start is None (skip is 0 then), else from start."""
    x = steps(high, low, close)
    if start is not None:
        return np.stack([gone_on(x[of][skip:] * factor, alpha, float(y)) for (of, alpha, factor), y in zip(FIRST_LEVEL.values(), start)])
    n, rows = 14, len(close)
    total = lambda v: smoothed(v * n, 1 / n, float(np.sum(v[1:n])), n - 1) if rows >= n else np.full(rows, np.nan)
    seeded = {f"ema_{k}": ema(close, k) for k in AVERAGES} | {"fast": ema(close, 12), "slow": ema(close, 26), "line_fast": ema(close, 12, 14)}
    seeded |= {f"{s}_{k}": wilder(x[s], k) for k in (14, 21) for s in ("gain", "loss", "range")} | {f"sum_{s}": total(x[s]) for s in ("range", "plus", "minus")}
    return np.stack([seeded[name] for name in FIRST_LEVEL])


def _named(first: np.ndarray) -> dict[str, np.ndarray]:
    return dict(zip(FIRST_LEVEL, first))


def _second_steps(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, +DI, -DI, DX) of rows whose first level is given."""
    y = _named(first)
    plus, minus = _share(y["sum_plus"], y["sum_range"]), _share(y["sum_minus"], y["sum_range"])
    return y["line_fast"] - y["slow"], plus, minus, _share(np.abs(plus - minus), plus + minus)


def second_level(first: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Values (signal and ADX, row): seeded where start is None, and first holds a series from its first row; else from start."""
    line, _, _, dx = _second_steps(first)
    if start is not None:
        return np.stack([gone_on(x, alpha, float(y)) for x, alpha, y in zip((line, dx), SECOND_LEVEL.values(), start)])
    signal, adx = np.full(len(line), np.nan), np.full(len(line), np.nan)
    if len(line) > 25:
        signal[25:] = ema(line[25:], 9)
    if len(dx) >= 28:
        adx = smoothed(dx, 1 / 14, float(np.mean(dx[14:28])), 27)
    return np.stack([signal, adx])


def carried_columns(high: np.ndarray, low: np.ndarray, close: np.ndarray, skip: int = 0, start: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(the columns of schema.RECURSIVE of rows from skip on, all recursions' last values).

    start: the recursions' values at row skip - 1; None: the rows are a series from its first bar, and skip is 0.
    """
    k = len(FIRST_LEVEL)
    first = first_level(high, low, close, skip, None if start is None else start[:k])
    second = second_level(first, None if start is None else start[k:])
    end = np.concatenate([first[:, -1], second[:, -1]])
    if start is None:
        return recursive_columns(high, low, close), end
    y, (line, plus, minus, _), (signal, adx) = _named(first), _second_steps(first), second
    momentum = np.where(y["slow"] > 0, (y["fast"] - y["slow"]) / np.where(y["slow"] > 0, y["slow"], 1.0), np.nan)
    return {f"ema_{n}": y[f"ema_{n}"] for n in AVERAGES} | {
        "macd": line, "macd_signal": signal, "macd_hist": line - signal, "momentum_score": momentum,
        "rsi_14": _share(y["gain_14"], y["gain_14"] + y["loss_14"]), "rsi_21": _share(y["gain_21"], y["gain_21"] + y["loss_21"]), "atr_14": y["range_14"], "atr_21": y["range_21"],
        "plus_di": plus, "minus_di": minus, "adx_14": adx,
    }, end


def composed(rows: np.ndarray, ends: np.ndarray, alphas: np.ndarray) -> np.ndarray:
    """What each block starts from, given in order of time their numbers of rows and their last values: the first one's as it is, others' from a start of 0.

    The first row of the result is of no use: the first block starts from its own seeds or state.
    """
    out, y = np.zeros_like(ends), ends[0]
    for b in range(1, len(ends)):
        out[b] = y
        y = (1 - alphas) ** rows[b] * y + ends[b]
    return out


FIRST_ALPHAS = np.array([alpha for _, alpha, _ in FIRST_LEVEL.values()])
SECOND_ALPHAS = np.array(list(SECOND_LEVEL.values()))
