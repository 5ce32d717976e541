"""Quality of any number of rows from states that merge: one state a series and period, made of a task's or a trigger's rows.

A state holds how many rows there are, how many each column lacks, the counts of integrity, and the
moments and co-moments of all features (about 80 kB).  A task makes one partial state a series
and period it meets; partial states of one are merged by many tasks, then by one, each
holding two at a time.  Missing values, moments, variance, integrity and correlations follow from
the state alone; outliers are counted in one further pass, over features whose least or
largest value is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import Moments
from ..schema import KEY
from .quality import CORRELATION_LIMIT, INTEGRITY, MISSING_LIMIT, OUTLIER_Z, assembled, long_form, numeric_columns

PERIOD = (*KEY, "period")
HELD = 128  # series and periods whose states a task holds before it emits them
SALTS = 32
STATE = "symbol string, interval string, period timestamp, part int, rows long, nulls array<long>, bad array<long>, moments binary"


def period_of(time: Column | str, seconds: int) -> Column:
    """Start of the period, counted from the epoch."""
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def counted_columns(columns: list[str]) -> list[str]:
    """The columns whose missing values count: all but timestamp, interval and period."""
    return [c for c in columns if c not in ("timestamp", "interval", "period")]


def _bad(x: pd.DataFrame) -> list[int]:
    return [int((x["high"] < x["low"]).sum()), *(int((x[c] < 0).sum()) for c in ("open", "high", "low", "close", "volume"))]


def partial_states(df: DataFrame) -> DataFrame:
    """STATE of the rows of df (features with a period), one or more of each series and period."""
    names, counted = numeric_columns(df), counted_columns(df.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        part = TaskContext.get().partitionId()

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*k, part, rows, nulls.tolist(), bad.tolist(), m.to_bytes()) for k, (rows, nulls, bad, m) in held.items()], columns=[c.split()[0] for c in STATE.split(", ")])

        for batch in batches:
            for key, x in batch.groupby(list(PERIOD), dropna=False, sort=False):
                new = [len(x), x[counted].isna().sum().to_numpy(), np.array(_bad(x)), Moments.of(x[names].to_numpy(float, na_value=np.nan))]
                held[key] = _sum(held[key], new) if key in held else new
            if len(held) > HELD:
                yield out()
                held = {}
        if held:
            yield out()

    return df.select(*PERIOD, *(c for c in df.columns if c not in PERIOD)).mapInPandas(run, STATE)


def _sum(a: list, b: list) -> list:
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3].merged(b[3])]


def merged_states(states: DataFrame, k: int) -> DataFrame:
    """One STATE a series and period; k: columns of the moments.  A series met by many tasks is merged by SALTS tasks first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, now = None, None

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*key, 0, int(now[0]), now[1].tolist(), now[2].tolist(), now[3].to_bytes())], columns=[c.split()[0] for c in STATE.split(", ")])

        for batch in batches:
            for row in batch.itertuples(index=False):
                new = [row.rows, np.array(row.nulls), np.array(row.bad), Moments.from_bytes(row.moments, k)]
                if (row.symbol, row.interval, row.period) == key:
                    now = _sum(now, new)
                    continue
                if key is not None:
                    yield out()
                key, now = (row.symbol, row.interval, row.period), new
        if key is not None:
            yield out()

    for salt in ([F.pmod("part", F.lit(SALTS))], []):
        states = states.repartition(*PERIOD, *salt).sortWithinPartitions(*PERIOD, *salt).mapInPandas(run, STATE)
    return states


def state_moments(states: DataFrame, names: list[str]) -> DataFrame:
    """As quality.moments, with least and largest value: one row a series, period and feature."""
    k = len(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                m = Moments.from_bytes(row.moments, k)
                n, second = np.diagonal(m.n), np.diagonal(m.second)
                with np.errstate(all="ignore"):
                    flat = m.low == m.high
                    std = np.where(n > 0, np.where(flat, 0.0, np.sqrt(second / n)), np.nan)
                    variance = np.where(n > 1, np.where(flat, 0.0, second / (n - 1)), np.nan)
                mean = np.where(n > 0, np.diagonal(m.mean), np.nan)
                yield pd.DataFrame({"symbol": row.symbol, "interval": row.interval, "period": row.period, "feature": names, "rows": row.rows, "present": n.astype(int), "mean": mean, "std": std, "variance": variance, "low": m.low, "high": m.high})

    got = states.mapInPandas(run, "symbol string, interval string, period timestamp, feature string, rows long, present long, mean double, std double, variance double, low double, high double")
    return got.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("mean", "std", "variance", "low", "high")})


def state_correlation(states: DataFrame, names: list[str], limit: float = CORRELATION_LIMIT) -> DataFrame:
    """As quality.correlation, over all rows of each series and period."""
    k = len(names)
    i, j = np.triu_indices(k, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with np.errstate(all="ignore"):
                    v = Moments.from_bytes(row.moments, k).correlations()[i, j]
                high = np.flatnonzero(np.abs(v) > limit)
                best = float(np.nanmax(np.abs(v))) if len(v) and not np.isnan(v).all() else 0.0
                pairs = [{"feature1": names[i[p]], "feature2": names[j[p]], "correlation": float(v[p])} for p in high]
                yield pd.DataFrame({"symbol": [row.symbol], "interval": [row.interval], "period": [row.period], "highly_correlated_pairs": [pairs], "max_correlation": [min(1.0, best)]})

    return states.mapInPandas(run, "symbol string, interval string, period timestamp, highly_correlated_pairs array<struct<feature1: string, feature2: string, correlation: double>>, max_correlation double")


def state_missing(states: DataFrame, counted: list[str]) -> DataFrame:
    """As quality.missing."""
    nulls = F.transform(F.arrays_zip(F.array(*map(F.lit, counted)).alias("feature"), F.col("nulls").alias("n")), lambda x: F.struct(x["feature"].alias("feature"), x["n"].alias("n")))
    held = states.select(*PERIOD, "rows", nulls.alias("nulls"))
    percent = lambda x: 100 * x["n"] / F.col("rows")
    some = F.filter("nulls", lambda x: x["n"] > 0)
    total = F.aggregate("nulls", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return held.select(
        *PERIOD, "rows", F.lit(len(counted)).cast("long").alias("total_features"), total.alias("total_missing"), (100 * total / (F.col("rows") * len(counted))).alias("missing_percentage"),
        F.map_from_entries(F.transform(some, lambda x: F.struct(x["feature"], percent(x)))).alias("features_with_missing"),
        F.transform(F.filter(some, lambda x: percent(x) > MISSING_LIMIT), lambda x: x["feature"]).alias("critical_missing_features"),
    )


def state_integrity(states: DataFrame) -> DataFrame:
    """As quality.integrity."""
    counted = states.select(*PERIOD, "rows", *(F.col("bad")[k].alias(n) for k, n in enumerate(INTEGRITY)))
    return counted.withColumn("is_valid", sum((F.col(n) for n in INTEGRITY), F.lit(0)) == 0)


def state_outliers(df: DataFrame, held: DataFrame) -> DataFrame:
    """As quality.outliers, from moments with least and largest values; df, the same rows, is read for features that have outliers.  max_zscore follows from the moments."""
    z = lambda x: F.abs((F.col(x) - F.col("mean")) / F.col("std"))
    worst = F.greatest(z("low"), z("high"))
    rated = held.where("present >= 3").withColumn("worst", F.when((F.col("std") > 0) & (worst > OUTLIER_Z), worst))
    odd = rated.where("worst is not null").select(*PERIOD, "feature", "mean", "std")
    counted = long_form(df, PERIOD).join(odd, [*PERIOD, "feature"]).where(z("value") > OUTLIER_Z).groupBy(*PERIOD, "feature").agg(F.count("*").alias("count"))
    out = rated.select(*PERIOD, "feature", "present", F.col("worst").alias("max_zscore")).join(counted, [*PERIOD, "feature"], "left").fillna(0, ["count"])
    return out.withColumn("percentage", 100 * F.col("count") / F.col("present"))


def state_reports(df: DataFrame, states: DataFrame, low: float = 70.0) -> DataFrame:
    """check_quality's report of each series and period, over all its rows: states are merged ones of the rows of df (features with a period)."""
    names = numeric_columns(df)
    held = state_moments(states, names)
    found = state_outliers(df, held)
    return assembled(names, PERIOD, state_missing(states, counted_columns(df.columns)), held, found, state_correlation(states, names), state_integrity(states), low)
