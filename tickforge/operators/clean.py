"""Cleaning, selection and first- or last-wins deduplication of klines and features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import series
from ..schema import BASE, KEY, PRICES


def closed_only(df: DataFrame) -> DataFrame:
    return df.where("is_closed")


def non_finite_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of all double and float columns become NULL."""
    bad = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return df.withColumns({c: F.when(~bad(c), F.col(c)) for c, kind in df.dtypes if kind in ("double", "float")})


def clean_ohlcv(df: DataFrame, backfill: bool = True) -> DataFrame:
    """Prices carried forward, then (not for streams) back, each column on its own; missing volume is 0.

    Carrying back only reaches the nulls before a series' first value, so that value is found once a series.
    """
    ahead, whole = series().rowsBetween(Window.unboundedPreceding, 0), series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = lambda c: F.coalesce(F.last(c, True).over(ahead), *([F.first(c, True).over(whole)] if backfill else []))
    finite = non_finite_to_null(df)
    return finite.withColumns({c: fill(c) for c in PRICES} | {"volume": F.coalesce("volume", F.lit(0.0))})


def require_columns(df: DataFrame, names: tuple[str, ...] = BASE) -> DataFrame:
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def min_history(df: DataFrame, n: int = 20) -> DataFrame:
    """Only series of at least n rows."""
    rows = F.count("*").over(Window.partitionBy(*KEY))
    return df.withColumn("__rows", rows).where(F.col("__rows") >= n).drop("__rows")


def select_series(df: DataFrame, symbols: list[str] | None = None, intervals: list[str] | None = None) -> DataFrame:
    for column, names in (("symbol", symbols), ("interval", intervals)):
        if names is not None:
            df = df.where(F.col(column).isin(names))
    return df


def annotate(df: DataFrame, version: int = 2) -> DataFrame:
    return df.withColumn("feature_version", F.lit(version).cast("long"))


def emit_slice(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of [start, end], once windows have seen the rows before."""
    return df.where((F.col("timestamp") >= start) & (F.col("timestamp") <= end))


def _one(df: DataFrame, keys: list[Column], pick: Callable[[Column, Column], Column], order_col: str) -> DataFrame:
    """One row of each key, by partial aggregation before the exchange.  Rows without order come first of all."""
    whole = pick(F.struct(*df.columns), F.struct(order_col)).alias("__row")
    return df.groupBy(*(k.alias(f"__key{i}") for i, k in enumerate(keys))).agg(whole).select("__row.*")


def dedupe_first(df: DataFrame, order_col: str) -> DataFrame:
    return _one(df, [*map(F.col, KEY), F.col("timestamp")], F.min_by, order_col)


def dedupe_last(df: DataFrame, order_col: str, whole_seconds: bool = False) -> DataFrame:
    """The latest arrival of each time; of each whole second, where asked for."""
    time = F.date_trunc("second", "timestamp") if whole_seconds else F.col("timestamp")
    return _one(df, [*map(F.col, KEY), time], F.max_by, order_col)
