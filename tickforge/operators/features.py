"""All features of a series: finite windows first, the recursive kernel last, one exchange.

features works through a series in one task; features_blocked cuts long series into blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.recursive import ema, recursive_columns, rsi, true_range, wilder
from ..functions.windows import mean, ratio, series
from ..schema import AVERAGES, BASE, FEATURES, KEY, RECURSIVE
from .blocks import in_blocks, with_running_sums
from .clean import annotate, clean_ohlcv, min_history, non_finite_to_null, require_columns
from .indicators import finite_features


def _kernel(make):
    """A grouped map that puts the columns of make(high, low, close) beside a series' own."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("timestamp", kind="stable").reset_index(drop=True)
        return rows.assign(**make(*(rows[c].to_numpy(float) for c in ("high", "low", "close"))))

    return run


def _with_columns(df: DataFrame, names: tuple[str, ...]) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in names] + [T.StructField(n, T.DoubleType()) for n in names])


def recursive_features(df: DataFrame) -> DataFrame:
    """The columns of schema.RECURSIVE beside those of df.  The kernel carries the rows through, so nothing is joined back."""
    df = df.drop(*(c for c in RECURSIVE if c in df.columns))
    return df.groupBy(*KEY).applyInPandas(_kernel(recursive_columns), _with_columns(df, RECURSIVE))


@dataclass(frozen=True)
class Calculator:
    """A user's own features.

    finite: columns by name, of windows over functions.windows.series() or of the row; they may use the bars' columns
    and the finite features.  recursive: a kernel from a series' (high, low, close) as arrays in order of time to
    arrays by name, with the names it gives in recursive_names.
    """

    finite: dict[str, Column] = field(default_factory=dict)
    recursive: Callable[[np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]] | None = None
    recursive_names: tuple[str, ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return (*self.finite, *self.recursive_names)


def features(klines: DataFrame, least_rows: int = 20, version: int = 2, calculators: tuple[Calculator, ...] = ()) -> DataFrame:
    """schema.FEATURES of every series of at least least_rows bars, then the columns of calculators: all in the one exchange."""
    own = [n for c in calculators for n in c.names]
    if clash := sorted({n for n in own if own.count(n) > 1 or n in FEATURES.names}):
        raise ValueError(f"columns of calculators that exist already: {', '.join(clash)}")
    held = min_history(require_columns(klines), least_rows)
    finite = finite_features(held.drop("quote_volume", "trades", "taker_buy_quote_volume", "is_closed"))
    finite = finite.withColumns({n: x for c in calculators for n, x in c.finite.items()})
    kernels = [(c.recursive, c.recursive_names) for c in calculators if c.recursive]

    def kernel(*prices: np.ndarray) -> dict[str, np.ndarray]:
        found = recursive_columns(*prices)
        for make, wanted in kernels:
            made = make(*prices)
            found |= {n: made[n] for n in wanted}
        return found

    names = (*RECURSIVE, *(n for _, wanted in kernels for n in wanted))
    found = finite.drop(*names).groupBy(*KEY).applyInPandas(_kernel(kernel), _with_columns(finite, names))
    return annotate(non_finite_to_null(found), version).select(*FEATURES.names, *own)


#: Bars of a block, and bars before it that its windows and recursions see.  What a bar weighs after HALO bars is
#: below 2^-236 for the slowest average and below the least double for the sums that rsi and directions divide.
BLOCK, HALO = 131_072, 16_384


def features_blocked(klines: DataFrame, least_rows: int = 20, version: int = 2, block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """features, by blocks of a series: for series of any length, at the price of a count and a join before the one exchange.

    Sums without end (obv, vwap) get those of earlier blocks.  halo: at least the 200 bars of the longest window;
    averages without end are as of the whole history as far as `halo` bars reach (see HALO).
    """
    if halo < max(AVERAGES):
        raise ValueError("a halo is at least the longest window")
    wanted = [*KEY, "timestamp", *BASE, *(c for c in ("taker_buy_volume",) if c in klines.columns)]
    held = in_blocks(require_columns(klines).select(*wanted), block, halo).where(F.col("total") >= least_rows)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    stepped = held.withColumn("change", F.col("close") - F.lag("close").over(series()))
    signed = F.when(F.col("place") == 0, F.col("volume")).otherwise(F.signum("change") * F.col("volume"))
    summed = with_running_sums(stepped, {"sum_signed": signed, "sum_paid": typical * F.col("volume"), "sum_volume": F.col("volume")})
    finite = finite_features(summed).withColumns({"obv": F.col("sum_signed"), "vwap": ratio(F.col("sum_paid"), F.col("sum_volume"))})
    found = recursive_features(finite.drop("sum_signed", "sum_paid", "sum_volume", "change", "place", "total", "of"))
    own = found.where("own").withColumn("symbol", F.col("series"))
    return annotate(non_finite_to_null(own), version).select(*FEATURES.names)


def features_latest(klines: DataFrame, lookback: int = 300, least_rows: int = 20) -> DataFrame:
    """The newest row's features of each series, from its newest `lookback` bars only; what the stream emits."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("timestamp").desc())
    held = klines.withColumn("__place", F.row_number().over(newest)).where(F.col("__place") <= lookback).drop("__place")
    found = features(held, least_rows)
    return found.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")


def features_each(klines: DataFrame, new: DataFrame, lookback: int = 300, least_rows: int = 20) -> DataFrame:
    """features_latest as of every bar of new (KEY, timestamp): each from its own newest `lookback` bars of klines.

    A bar of klines goes once to each new bar that looks back on it, and these windows, not series, are the groups.
    """
    newest_first = Window.partitionBy(*KEY).orderBy(F.col("timestamp").desc())
    placed = klines.join(new.select(*KEY, "timestamp").distinct().withColumn("__new", F.lit(True)), [*KEY, "timestamp"], "left").withColumn("__place", F.row_number().over(newest_first))
    next_new = F.max(F.when(F.col("__new"), F.col("__place"))).over(newest_first.rowsBetween(Window.unboundedPreceding, 0))
    seen = placed.withColumn("__next", next_new).where(F.col("__place") - F.col("__next") < lookback)
    ahead = Window.partitionBy(*KEY).orderBy("__place").rangeBetween(1 - lookback, 0)
    dealt = seen.withColumn("__of", F.collect_list(F.when(F.col("__new"), F.unix_micros("timestamp"))).over(ahead)).withColumn("__of", F.explode("__of"))
    named = dealt.withColumn("symbol", F.concat("symbol", F.lit("@"), F.col("__of").cast("string"))).drop("__new", "__place", "__next", "__of")
    last = features(named, least_rows).where(F.substring_index("symbol", "@", -1).cast("long") == F.unix_micros("timestamp"))
    return last.withColumn("symbol", F.regexp_replace("symbol", "@-?[0-9]+$", ""))


REALTIME = (*(f"ema_{n}" for n in AVERAGES), "rsi_14", "atr_14")


def _realtime_columns(high, low, close):
    return {f"ema_{n}": ema(close, n) for n in AVERAGES} | {"rsi_14": rsi(close, 14), "atr_14": wilder(true_range(high, low, close), 14)}


def realtime_features(klines: DataFrame) -> DataFrame:
    """Cleaned bars with simple and exponential averages, rsi_14 and atr_14."""
    held = clean_ohlcv(require_columns(klines)).select(*KEY, "timestamp", *BASE)
    averaged = held.withColumns({f"sma_{n}": mean(F.col("close"), n) for n in AVERAGES})
    return averaged.groupBy(*KEY).applyInPandas(_kernel(_realtime_columns), _with_columns(averaged, REALTIME))
