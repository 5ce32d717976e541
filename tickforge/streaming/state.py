"""Keyed state of series: rings of newest bars, and last values for filling.

A series' state is one value in the state store: of rings the newest bars' numbers as bytes,
of fills the last values.  What a trigger costs follows from its bars, not from tables or
histories.  States of series that rest longer than `idle_ms` expire; their next bar starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.rings import window_features
from ..schema import BASE, KEY, KLINE, PRICES, VALUES

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RING = ("timestamp", *BASE, "taker_buy_volume")  # a ring's rows of float64; times are microseconds, whole numbers below 2^53


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within keep their state in RocksDB, which transformWithState needs; the session's setting is as it was after."""
    held = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if held is None else spark.conf.set(_PROVIDER, held)


def later_rows(batches: Iterator[pd.DataFrame], last_us: int | None, order_col: str | None) -> pd.DataFrame:
    """A trigger's rows, in order of arrival (order_col) or time, that are strictly later than all before them and than last_us."""
    rows = pd.concat(list(batches)).sort_values(order_col or "timestamp", kind="stable")
    before = rows["timestamp"].cummax().shift(1)
    if last_us is not None:
        last = pd.Timestamp(last_us, unit="us")
        before = before.fillna(last).clip(lower=last)
    return rows[before.isna() | (rows["timestamp"] > before)]


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype(np.int64)


class _Held(StatefulProcessor):
    """A processor with one value of state; fields: its layout."""

    fields: T.StructType

    def __init__(self, order_col: str | None, idle_ms: int | None):
        self.order_col, self.idle_ms = order_col, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", self.fields, self.idle_ms)

    def close(self) -> None:
        pass


class Rings(_Held):
    """New bars, each with the features of its own newest `lookback` bars; null where a series has fewer than least_rows."""

    fields = T.StructType([T.StructField("ring", T.BinaryType())])

    def __init__(self, lookback: int, least_rows: int, order_col: str | None, idle_ms: int | None):
        super().__init__(order_col, idle_ms)
        self.lookback, self.least_rows = lookback, least_rows

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = np.frombuffer(bytes(self.state.get()[0]), np.float64).reshape(len(RING), -1) if self.state.exists() else np.zeros((len(RING), 0))
        new = later_rows(rows, int(held[0, -1]) if held.shape[1] else None, self.order_col).reset_index(drop=True)
        if not len(new):
            return
        fresh = np.stack([_micros(new["timestamp"]).astype(float), *(pd.to_numeric(new[c]).to_numpy(float, na_value=np.nan) for c in RING[1:])])
        ring, first = np.concatenate([held, fresh], axis=1), held.shape[1]
        found = window_features(dict(zip(RING[1:], ring[1:])), first, self.lookback)
        enough = np.arange(first, ring.shape[1]) + 1 >= self.least_rows
        self.state.update((np.ascontiguousarray(ring[:, max(0, ring.shape[1] - self.lookback + 1) :]).tobytes(),))
        yield new[KLINE.names].assign(**{f"feature_{c}": np.where(enough, found[c], np.nan) for c in VALUES}, has_features=enough)


RING_ROWS = T.StructType([*KLINE.fields, *(T.StructField(f"feature_{c}", T.DoubleType()) for c in VALUES), T.StructField("has_features", T.BooleanType())])


class Fills(_Held):
    """New bars with prices carried forward, each column on its own; missing volume is 0."""

    fields = T.StructType([T.StructField("last", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in PRICES)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.state.get() if self.state.exists() else (None,) * 5
        new = later_rows(rows, held[0], self.order_col)
        if not len(new):
            return
        doubles = [c for c in new.columns if new[c].dtype.kind == "f"]
        new = new.assign(**{c: new[c].where(np.isfinite(new[c])) for c in doubles})
        ends = {}
        for c, last in zip(PRICES, held[1:]):
            filled = new[c].ffill()
            new[c] = filled if last is None else filled.fillna(last)
            end = new[c].iloc[-1]
            ends[c] = None if pd.isna(end) else float(end)
        new["volume"] = new["volume"].fillna(0.0)
        self.state.update((int(_micros(new["timestamp"])[-1]), *(ends[c] for c in PRICES)))
        yield new


def ring_features(klines: DataFrame, lookback: int = 300, least_rows: int = 20, order_col: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """A stream of RING_ROWS: each bar later than all before it, once, with the features of its own newest `lookback` bars.

    Late and repeated bars go as in monotonic_bars.  To be started within keyed_state.
    """
    return klines.groupBy(*KEY).transformWithStateInPandas(Rings(lookback, least_rows, order_col, idle_ms), RING_ROWS, "Append", "None" if idle_ms is None else "ProcessingTime")


def stream_clean(klines: DataFrame, order_col: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """clean_ohlcv without carrying back, on a stream: prices that are missing or not finite are the series' last ones; late and repeated bars are refused.

    To be started within keyed_state.
    """
    return klines.groupBy(*KEY).transformWithStateInPandas(Fills(order_col, idle_ms), klines.schema, "Append", "None" if idle_ms is None else "ProcessingTime")
