"""Features of many bars at once, each from a window of its own newest bars.

Windows are rows of matrices, filled with NaN on the left where a series has fewer bars; all
sums run along rows, so the work is the number of bars times the width, however many bars
come at once.  NaN is a missing value; recursions pass over bars that lack one.
"""

from __future__ import annotations

import math

import numpy as np

from ..schema import AVERAGES, BASE, FINITE, RECURSIVE
from .carried import FIRST_LEVEL, steps
from .recursive import _share

YEAR = math.sqrt(252)
CHUNK = 512
#: (row of a window at which it is seeded, how many values' sum, over what), in the order of FIRST_LEVEL.
_SEEDS = {name: (int(name.split("_")[1]) - 1, None, int(name.split("_")[1])) for name in FIRST_LEVEL if name.startswith("ema_")}
_SEEDS |= {"fast": (11, None, 12), "slow": (25, None, 26), "line_fast": (25, 12, 12)}
_SEEDS |= {f"{x}_{n}": (n, None, n) for n in (14, 21) for x in ("gain", "loss", "range")} | {f"sum_{x}": (13, None, 14) for x in ("range", "plus", "minus")}


def windows(x: np.ndarray, first: int, width: int) -> np.ndarray:
    """For each place from first on, the `width` values up to it."""
    held = np.concatenate([np.full(width - 1, np.nan), x])
    return np.lib.stride_tricks.sliding_window_view(held, width)[first:]


def _last(agg, x: np.ndarray, n: int) -> np.ndarray:
    """agg of the last n values; NaN where any is missing."""
    return agg(x[:, -n:], axis=1) if n <= x.shape[1] else np.full(len(x), np.nan)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, a / np.where(b > 0, b, 1.0), np.nan)


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.full((len(x), 1), np.nan), x[:, :-1]], axis=1)


def _finite(w: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    """schema.FINITE of the last bar of each window; rows: how many bars each window has."""
    h, l, c, v = (w[k] for k in ("high", "low", "close", "volume"))  # noqa: E741
    mean, std = (lambda x, n: _last(np.mean, x, n)), (lambda x, n: _last(np.std, x, n))
    end = {k: x[:, -1] for k, x in w.items()}
    before = _before(c)
    change, ret, tp = c - before, _ratio(c, before) - 1, (h + l + c) / 3
    tp_change = tp - _before(tp)
    many, avg_volume, moved = rows > 20, mean(v, 20), tp * v
    lo20, hi20 = _last(np.min, l, 20), _last(np.max, h, 20)
    lo14, hi14 = _last(np.min, l, 14), _last(np.max, h, 14)
    mid, dev = mean(c, 20), std(c, 20)
    width, tp20 = 4 * dev, mean(tp, 20)
    off = _last(np.mean, np.abs(tp - tp20[:, None]), 20)
    up, down = (_last(np.nansum, np.where(sign, moved, 0.0), 14) for sign in (tp_change > 0, tp_change < 0))
    fast = []
    for k in range(5):  # of the last five bars, the newest first
        cut = slice(None, c.shape[1] - k)
        lo, hi = _last(np.min, l[:, cut], 14), _last(np.max, h[:, cut], 14)
        span = hi - lo
        fast.append(np.where(span > 0, 100 * (c[:, cut][:, -1] - lo) / np.where(span > 0, span, 1.0), np.where(np.isnan(span), np.nan, 0.0)) if c.shape[1] > k else np.full(len(c), np.nan))
    slow = [sum(fast[k : k + 3]) / 3 for k in range(3)]
    stoch_d = sum(slow) / 3
    signed = np.sign(change) * v
    place = np.arange(c.shape[1])[None, :] - (c.shape[1] - rows)[:, None]
    signed = np.where(place == 0, v, signed)
    paid, sold = np.nansum(moved, axis=1), np.nansum(v, axis=1)
    bought = _ratio(w["taker_buy_volume"], v)
    log = np.log(np.where((h > 0) & (l > 0), h / np.where(l > 0, l, 1.0), np.nan))
    dev_ret, range14, range20 = std(ret, 20), hi14 - lo14, hi20 - lo20
    safe = lambda x: np.where(x > 0, x, 1.0)
    trend = mean(c, 50)
    kyle = np.where(v > 0, np.abs(np.where(np.isnan(change), 0.0, change)) / np.sqrt(safe(v)), np.nan)
    out = {f"sma_{n}": mean(c, n) for n in AVERAGES} | {
        "bb_middle": np.where(many, mid, np.nan), "bb_upper": np.where(many, mid + 2 * dev, np.nan), "bb_lower": np.where(many, mid - 2 * dev, np.nan), "bb_width": np.where(many, width, np.nan),
        "bb_percent": np.where(many, np.where(width > 0, (end["close"] - (mid - 2 * dev)) / safe(width), 0.5), np.nan),
        "cci_20": np.where(many & ~np.isnan(tp20), np.where(off > 0, (tp[:, -1] - tp20) / (0.015 * safe(off)), 0.0), np.nan),
        "stoch_k": np.where(np.isnan(stoch_d), np.nan, slow[0]), "stoch_d": stoch_d,
        "williams_r": np.where(range14 > 0, -100 * (hi14 - end["close"]) / safe(range14), np.where(np.isnan(range14), np.nan, 0.0)),
        "mfi_14": np.where(_last(np.sum, ~np.isnan(tp_change), 14) == 14, np.where(up + down < 1, 0.0, 100 * up / np.maximum(up + down, 1.0)), np.nan),
        "obv": np.nansum(signed, axis=1), "vwap": _ratio(paid, sold),
        "volume_ratio": _ratio(end["volume"], avg_volume), "volatility_20": dev_ret * YEAR, "volatility_50": std(ret, 50) * YEAR,
        "realized_volatility": mean(np.sqrt(log**2 / (4 * math.log(2))), 20) * YEAR,
        "price_position": np.where(range20 > 0, (end["close"] - lo20) / safe(range20), 0.5), "trend_strength": _ratio(end["close"] - trend, trend), "volume_momentum": _ratio(mean(v, 5), avg_volume),
        "buy_pressure": bought[:, -1], "order_flow_imbalance": mean(bought, 20) - 0.5,
        "sharpe_ratio_20": np.where(dev_ret > 0, mean(ret, 20) / safe(dev_ret), 0.0), "spread_ratio": _ratio(end["high"] - end["low"], end["close"]),
        "avg_spread": mean(h - l, 20), "spread_volatility": std(h - l, 20), "kyle_lambda": mean(kyle, 20), "amihud_illiquidity": mean(_ratio(np.abs(ret), c * v), 20),
        "price_impact": _ratio(np.abs(ret[:, -1]), _ratio(end["volume"], avg_volume)), "volume_turnover": _ratio(_last(np.sum, v, 20), _last(np.sum, v, 100)),
        "effective_spread": 2 * np.abs(end["close"] - (end["high"] + end["low"]) / 2),
    }
    return {k: out[k] for k in FINITE}


def _recursive(high: np.ndarray, low: np.ndarray, close: np.ndarray, rows: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """schema.RECURSIVE of the last len(rows) bars, seeded at the first bar of each one's window."""
    n = len(rows)
    x = {k: windows(v, len(close) - n, width) for k, v in steps(high, low, close).items()}
    names, alphas = list(FIRST_LEVEL), np.array([a for _, a, _ in FIRST_LEVEL.values()])[:, None]
    run = np.stack([x[of] * factor for of, _, factor in FIRST_LEVEL.values()])  # recursion, window, bar
    place = np.arange(width)[None, :] - (width - rows)[:, None]
    changes = np.array([of != "close" for of, _, _ in FIRST_LEVEL.values()])
    run[changes] = np.where(place == 0, np.nan, run[changes])  # a window's first bar has none before it
    total = np.cumsum(np.nan_to_num(run), axis=2)
    first, divide = np.array([_SEEDS[k][0] for k in names])[:, None], np.array([float(_SEEDS[k][2]) for k in names])[:, None]
    late = names.index("line_fast")
    fast, slow = names.index("line_fast"), names.index("slow")
    ranges, plus, minus = (names.index(f"sum_{k}") for k in ("range", "plus", "minus"))
    y, signal, adx, line_sum, dx_sum = np.full((len(names), n), np.nan), np.full(n, np.nan), np.full(n, np.nan), np.zeros(n), np.zeros(n)
    line = plus_di = minus_di = np.full(n, np.nan)
    for j in range(width):
        p, now = place[:, j], run[:, :, j]
        seed = total[:, :, j] / divide
        if j >= 12:
            seed[late] = (total[late, :, j] - total[late, :, j - 12]) / 12
        moved = np.where(np.isnan(now), y, y + alphas * (now - y))
        y = np.where(p > first, moved, np.where(p == first, seed, y))
        line = y[fast] - y[slow]
        line_sum += np.where((p >= 25) & (p <= 33), line, 0.0)
        signal = np.where(p > 33, signal + 0.2 * (line - signal), np.where(p == 33, line_sum / 9, signal))
        plus_di, minus_di = _share(y[plus], y[ranges]), _share(y[minus], y[ranges])
        dx = _share(np.abs(plus_di - minus_di), plus_di + minus_di)
        dx_sum += np.where((p >= 14) & (p <= 27), dx, 0.0)
        adx = np.where(p > 27, adx + (dx - adx) / 14, np.where(p == 27, dx_sum / 14, adx))
    at = dict(zip(names, y))
    ripe = rows > 14
    out = {f"ema_{k}": at[f"ema_{k}"] for k in AVERAGES} | {
        "macd": np.where(np.isnan(signal), np.nan, line), "macd_signal": signal, "macd_hist": line - signal, "momentum_score": _ratio(at["fast"] - at["slow"], at["slow"]),
        "rsi_14": _share(at["gain_14"], at["gain_14"] + at["loss_14"]), "rsi_21": _share(at["gain_21"], at["gain_21"] + at["loss_21"]), "atr_14": at["range_14"], "atr_21": at["range_21"],
        "plus_di": np.where(ripe, plus_di, np.nan), "minus_di": np.where(ripe, minus_di, np.nan), "adx_14": adx,
    }
    return {k: out[k] for k in RECURSIVE}


def window_features(bars: dict[str, np.ndarray], first: int, width: int) -> dict[str, np.ndarray]:
    """schema.VALUES of the bars from place `first` on, each from its newest `width` bars; bars: BASE and taker_buy_volume of a series in order of time."""
    n = len(bars["close"])
    parts = []
    for lo in range(first, n, CHUNK):
        hi, start = min(n, lo + CHUNK), max(0, lo - width + 1)
        w = {k: windows(x[start:hi], lo - start, width) for k, x in bars.items()}
        rows = np.minimum(np.arange(lo, hi) + 1, width)
        with np.errstate(all="ignore"):
            parts.append(_finite(w, rows) | _recursive(*(bars[k][start:hi] for k in ("high", "low", "close")), rows, width))
    if not parts:
        return {k: np.zeros(0) for k in (*BASE, *FINITE, *RECURSIVE)}
    found = {k: np.concatenate([p[k] for p in parts]) for k in (*FINITE, *RECURSIVE)}
    return {k: bars[k][first:] for k in BASE} | {k: np.where(np.isfinite(x), x, np.nan) for k, x in found.items()}
