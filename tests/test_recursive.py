"""The recursive kernel against plain loops."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickforge.functions import recursive as R


def loop_ema(x, n, start=0):
    out = [float("nan")] * len(x)
    for i in range(len(x)):
        if i == start + n - 1:
            out[i] = sum(x[start : start + n]) / n
        elif i > start + n - 1:
            out[i] = out[i - 1] + 2 / (n + 1) * (x[i] - out[i - 1])
    return np.array(out)


def loop_wilder(x, n):
    out = [float("nan")] * len(x)
    for i in range(len(x)):
        if i == n:
            out[i] = sum(x[1 : n + 1]) / n
        elif i > n:
            out[i] = (out[i - 1] * (n - 1) + x[i]) / n
    return np.array(out)


def loop_directional(h, l, c, n=14):
    size = len(c)
    tr, pdm, mdm = [0.0] * size, [0.0] * size, [0.0] * size
    for i in range(1, size):
        tr[i] = max(h[i] - l[i], abs(h[i] - c[i - 1]), abs(l[i] - c[i - 1]))
        up, down = h[i] - h[i - 1], l[i - 1] - l[i]
        pdm[i], mdm[i] = (up if up > down and up > 0 else 0), (down if down > up and down > 0 else 0)
    plus, minus, adx, dx = ([float("nan")] * size for _ in range(4))
    s = [sum(x[1:n]) for x in (tr, pdm, mdm)]
    for i in range(n, size):
        s = [a - a / n + x[i] for a, x in zip(s, (tr, pdm, mdm))]
        plus[i], minus[i] = (100 * a / s[0] if s[0] else 0.0 for a in s[1:])
        both = plus[i] + minus[i]
        dx[i] = 100 * abs(plus[i] - minus[i]) / both if both else 0.0
        if i == 2 * n - 1:
            adx[i] = sum(dx[n : 2 * n]) / n
        elif i >= 2 * n:
            adx[i] = (adx[i - 1] * (n - 1) + dx[i]) / n
    return np.array(plus), np.array(minus), np.array(adx)


def series(size, seed=0):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(size=size))
    high, low = close + rng.random(size), close - rng.random(size)
    return high, low, close


@pytest.mark.parametrize("size", [1, 9, 14, 15, 20, 26, 27, 28, 33, 34, 35, 201])
def test_kernel_equals_loops(size):
    h, l, c = series(size)
    got = R.recursive_columns(h, l, c)
    for n in (10, 20, 50, 100, 200):
        np.testing.assert_allclose(got[f"ema_{n}"], loop_ema(c, n), rtol=1e-12)
    line = loop_ema(c, 12, 14) - loop_ema(c, 26)
    signal = np.full(size, np.nan)
    if size > 25:
        signal[25:] = loop_ema(line[25:], 9)
    np.testing.assert_allclose(got["macd_signal"], signal, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(got["macd"], np.where(np.isnan(signal), np.nan, line), rtol=1e-9, atol=1e-12)
    change = np.diff(c, prepend=c[0])
    for n in (14, 21):
        g, d = loop_wilder(np.maximum(change, 0), n), loop_wilder(np.maximum(-change, 0), n)
        np.testing.assert_allclose(got[f"rsi_{n}"], 100 * g / (g + d), rtol=1e-9)
    for name, want in zip(("plus_di", "minus_di", "adx_14"), loop_directional(h, l, c)):
        np.testing.assert_allclose(got[name], want, rtol=1e-9)


def test_first_values():
    h, l, c = series(300)
    first = {n: int(np.flatnonzero(~np.isnan(x))[0]) for n, x in R.recursive_columns(h, l, c).items()}
    assert first["ema_200"] == 199 and first["macd"] == first["macd_hist"] == 33 and first["momentum_score"] == 25
    assert first["rsi_14"] == first["atr_14"] == first["plus_di"] == 14 and first["adx_14"] == 27 and first["atr_21"] == 21


def test_constant_prices():
    c = np.full(60, 5.0)
    got = R.recursive_columns(c, c, c)
    assert got["rsi_14"][20] == 0 and got["adx_14"][40] == 0 and got["macd_hist"][40] == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(1, 1e4), min_size=1, max_size=120))
def test_bounds_and_scaling(prices):
    c = np.array(prices)
    got, twice = R.recursive_columns(c, c, c), R.recursive_columns(2 * c, 2 * c, 2 * c)
    for name in ("rsi_14", "plus_di", "adx_14"):
        x = got[name][~np.isnan(got[name])]
        assert ((x >= -1e-9) & (x <= 100 + 1e-9)).all()
        np.testing.assert_allclose(got[name], twice[name], rtol=1e-6, atol=1e-6)
