"""Bars from trades, from finer bars, and from blocks of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import INTERVAL_MS
from ..functions.windows import series
from ..schema import KEY, KLINE, SUMS


def _span(interval: str) -> str:
    return f"{INTERVAL_MS[interval] // 1000} seconds"


def trade_bar_columns() -> list[Column]:
    """Aggregates of one bar's trades; of equal times the lower id comes first."""
    order, value = F.struct("timestamp", "id"), F.col("price") * F.col("quantity")
    bought = lambda x: F.sum(F.when(~F.col("is_buyer_maker"), x).otherwise(0.0))
    return [
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"), F.sum(value).alias("quote_volume"), F.count("*").alias("trades"), bought(F.col("quantity")).alias("taker_buy_volume"), bought(value).alias("taker_buy_quote_volume"),
    ]


def bars_from_trades(trades: DataFrame, interval: str) -> DataFrame:
    """OHLCV bars on the UTC clock; partial sums before the one exchange by symbol and bar."""
    bars = trades.groupBy("symbol", F.window("timestamp", _span(interval)).alias("w")).agg(*trade_bar_columns())
    return bars.withColumns({"interval": F.lit(interval), "timestamp": F.col("w.start"), "is_closed": F.lit(True)}).select(*KLINE.names)


def resample_bars(klines: DataFrame, interval: str) -> DataFrame:
    """Bars of a coarser interval from finer ones, labelled by their start."""
    bars = klines.groupBy("symbol", F.window("timestamp", _span(interval)).alias("w")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"),
        F.sum("trades").alias("trades"), *(F.sum(c).alias(c) for c in SUMS),
    )
    return bars.withColumns({"interval": F.lit(interval), "timestamp": F.col("w.start"), "is_closed": F.lit(True)}).select(*KLINE.names)


#: The known intervals up to a day; fixed values.
LADDER = ("1m", "3m", "5m", "15m", "30m", "1h", "2h", "4h", "6h", "8h", "12h", "1d")


def parent_interval(interval: str, among: tuple[str, ...]) -> str | None:
    """The longest shorter interval of `among` that divides it."""
    held = [i for i in among if INTERVAL_MS[i] < INTERVAL_MS[interval] and INTERVAL_MS[interval] % INTERVAL_MS[i] == 0]
    return max(held, key=INTERVAL_MS.__getitem__, default=None)


def _rolled(finer: DataFrame, interval: str) -> DataFrame:
    """(symbol, day, timestamp, columns of a bar) from finer bars of the same layout; day holds every bar of an interval that divides it."""
    size = INTERVAL_MS[interval] * 1000
    start = F.timestamp_micros(F.unix_micros("timestamp") - F.pmod(F.unix_micros("timestamp"), F.lit(size)))
    return finer.groupBy("symbol", "day", start.alias("start")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"),
        F.sum("trades").alias("trades"), *(F.sum(c).alias(c) for c in SUMS),
    ).withColumnRenamed("start", "timestamp")


def bars_of_all_intervals(trades: DataFrame, intervals: tuple[str, ...] = LADDER) -> DataFrame:
    """KLINE bars of several intervals from one reading of trades.

    Trades become bars of the finest interval, which are dealt by symbol and day; every coarser interval is rolled up from
    the longest one that divides it, within its task, as bars are states that merge.  Intervals divide a day.
    """
    if any(86_400_000 % INTERVAL_MS[i] for i in intervals):
        raise ValueError("intervals of the ladder divide a day")
    finest = min(intervals, key=INTERVAL_MS.__getitem__)
    if odd := [i for i in intervals if INTERVAL_MS[i] % INTERVAL_MS[finest]]:
        raise ValueError(f"the finest interval does not divide {odd[0]}")
    day = F.timestamp_micros(F.unix_micros("timestamp") - F.pmod(F.unix_micros("timestamp"), F.lit(86_400_000_000)))
    rungs = {finest: bars_from_trades(trades, finest).drop("interval", "is_closed").withColumn("day", day).repartition("symbol", "day")}
    for i in sorted(intervals, key=INTERVAL_MS.__getitem__)[1:]:
        rungs[i] = _rolled(rungs[parent_interval(i, intervals)], i)
    shown = [rungs[i].withColumns({"interval": F.lit(i), "is_closed": F.lit(True)}).select(*KLINE.names) for i in intervals]
    whole = shown[0]
    for more in shown[1:]:
        whole = whole.unionByName(more)
    return whole


def _block_value(name: str) -> Column:
    """By the name's part before the first _; volume_ratio and its like are therefore sums."""
    return {
        "open": F.min_by(name, "timestamp"), "high": F.max(name), "low": F.min(name), "close": F.max_by(name, "timestamp"), "volume": F.sum(name), "ema": F.max_by(name, "timestamp"),
    }.get(name.split("_")[0], F.avg(name)).alias(name)


def downsample_blocks(df: DataFrame, factor: int) -> DataFrame:
    """One row for each `factor` rows of a series, by position, labelled by the first; a partial last block is left out."""
    if factor <= 1:
        return df
    values = [c for c, kind in df.dtypes if c not in (*KEY, "timestamp") and kind in ("double", "float", "int", "bigint")]
    placed = df.withColumn("__block", F.floor((F.row_number().over(series()) - 1) / factor))
    blocks = placed.groupBy(*KEY, "__block").agg(F.count("*").alias("__rows"), F.min("timestamp").alias("timestamp"), *map(_block_value, values))
    return blocks.where(F.col("__rows") == factor).select(*KEY, "timestamp", *values)
