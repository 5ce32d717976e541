"""Quality of feature tables: missing values, outliers, correlation, variance, integrity, scores, and a report a series.

Reports look at a bounded number of the newest rows of each series (`newest`, the feature's
own limit), so a series' rows fit one task for the pairwise correlations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY
from ..sources.scratch import settled

MISSING_LIMIT, OUTLIER_Z, OUTLIER_LIMIT, CORRELATION_LIMIT, VARIANCE_LIMIT = 5.0, 3.0, 1.0, 0.95, 1e-10
NOT_FEATURES = ("feature_version",)


def newest(df: DataFrame, n: int = 1000) -> DataFrame:
    order = Window.partitionBy(*KEY).orderBy(F.col("timestamp").desc())
    return df.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= n).drop("__place")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind in ("double", "float", "int", "bigint") and c not in NOT_FEATURES]


def long_form(df: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """(keys, feature, value)."""
    names = numeric_columns(df)
    return df.select(*keys, *(F.col(c).cast("double").alias(c) for c in names)).unpivot(list(keys), names, "feature", "value")


def moments(df: DataFrame) -> DataFrame:
    """Counts and moments of each series' features; variance is exactly 0 for constant ones."""
    low, high, v = F.min("value"), F.max("value"), F.col("value")
    constant = low == high
    return long_form(df).groupBy(*KEY, "feature").agg(
        F.count("*").alias("rows"), F.count(v).alias("present"), F.avg(v).alias("mean"),
        F.when(constant, 0.0).otherwise(F.stddev_pop(v)).alias("std"), F.when(F.count(v) > 1, F.when(constant, 0.0).otherwise(F.var_samp(v))).alias("variance"),
    )


def missing(df: DataFrame) -> DataFrame:
    """(rows, total_features, total_missing, missing_percentage, features_with_missing, critical_missing_features) of each series, over all columns but timestamp."""
    columns = [c for c in df.columns if c not in ("timestamp", "interval")]
    nulls = F.array(*(F.struct(F.lit(c).alias("feature"), F.count(F.when(F.col(c).isNull(), 1)).alias("n")) for c in columns))
    counted = df.groupBy(*KEY).agg(F.count("*").alias("rows"), nulls.alias("nulls"))
    percent = lambda x: 100 * x["n"] / F.col("rows")
    some = F.filter("nulls", lambda x: x["n"] > 0)
    total = F.aggregate("nulls", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return counted.select(
        *KEY, "rows", F.lit(len(columns)).cast("long").alias("total_features"), total.alias("total_missing"), (100 * total / (F.col("rows") * len(columns))).alias("missing_percentage"),
        F.map_from_entries(F.transform(some, lambda x: F.struct(x["feature"], percent(x)))).alias("features_with_missing"),
        F.transform(F.filter(some, lambda x: percent(x) > MISSING_LIMIT), lambda x: x["feature"]).alias("critical_missing_features"),
    )


def outliers(df: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(feature, present, count, percentage, max_zscore) of each series' features of at least 3 values: |z| above 3, z by population deviation."""
    held = moments(df) if held is None else held
    scored = long_form(df).join(held.where("present >= 3 and std > 0").select(*KEY, "feature", "mean", "std"), [*KEY, "feature"])
    z = F.abs((F.col("value") - F.col("mean")) / F.col("std"))
    found = scored.groupBy(*KEY, "feature").agg(F.count(F.when(z > OUTLIER_Z, 1)).alias("count"), F.max(F.when(z > OUTLIER_Z, z)).alias("max_zscore"))
    out = held.where("present >= 3").select(*KEY, "feature", "present").join(found, [*KEY, "feature"], "left").fillna(0, ["count"])
    return out.withColumn("percentage", 100 * F.col("count") / F.col("present"))


def _pairs(names: list[str], limit: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[names].to_numpy(float)
        mask = ~np.isnan(x)
        counts = mask.sum(axis=0)
        centre = np.where(counts > 0, np.where(mask, x, 0).sum(axis=0) / np.maximum(counts, 1), 0)
        y = np.where(mask, x - centre, 0.0)
        m = mask.astype(float)
        n, s, q = m.T @ m, y.T @ m, (y * y).T @ m
        with np.errstate(all="ignore"):
            cov, var = y.T @ y - s * s.T / n, q - s * s / n
            scale = np.maximum(q, 1e-300)
            var = np.where(var <= 1e-13 * scale, np.nan, var)
            r = cov / np.sqrt(var * var.T)
        i, j = np.triu_indices(len(names), 1)
        v = r[i, j]
        high = np.flatnonzero(np.abs(v) > limit)
        best = float(np.nanmax(np.abs(v))) if len(v) and not np.isnan(v).all() else 0.0
        pairs = [{"feature1": names[i[k]], "feature2": names[j[k]], "correlation": float(v[k])} for k in high]
        return pd.DataFrame({"symbol": [rows["symbol"].iloc[0]], "interval": [rows["interval"].iloc[0]], "highly_correlated_pairs": [pairs], "max_correlation": [min(1.0, best)]})

    return run


def correlation(df: DataFrame, limit: float = CORRELATION_LIMIT) -> DataFrame:
    """Pairs of features, in column order, whose pairwise-complete correlation is beyond the limit; the largest in size (0 where none is defined)."""
    names = numeric_columns(df)
    return df.select(*KEY, *names).groupBy(*KEY).applyInPandas(_pairs(names, limit), "symbol string, interval string, highly_correlated_pairs array<struct<feature1: string, feature2: string, correlation: double>>, max_correlation double")


def low_variance(held: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """(low_variance_features, zero_variance_count) of each series, from its moments."""
    low = F.col("variance") < VARIANCE_LIMIT
    return held.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(low, F.struct("feature", "variance")))).alias("low_variance_features"), F.count(F.when(F.col("variance") == 0, 1)).alias("zero_variance_count"))


INTEGRITY = ("high_less_than_low", *(f"negative_{c}" for c in ("open", "high", "low", "close")), "negative_volume")


def integrity(df: DataFrame) -> DataFrame:
    """(rows, the six counts of INTEGRITY, is_valid) of each series."""
    tests = (F.col("high") < F.col("low"), *(F.col(c) < 0 for c in ("open", "high", "low", "close", "volume")))
    counted = df.groupBy(*KEY).agg(F.count("*").alias("rows"), *(F.count(F.when(t, 1)).alias(n) for n, t in zip(INTEGRITY, tests)))
    return counted.withColumn("is_valid", sum((F.col(n) for n in INTEGRITY), F.lit(0)) == 0)


def feature_scores(held: DataFrame, found: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """(feature, score) from moments and outliers: 100, less for missing values, outliers and low variance, at least 0."""
    both = held.join(found.select(*keys, "feature", "percentage"), [*keys, "feature"], "left")
    gone = 100 * (F.col("rows") - F.col("present")) / F.col("rows")
    odd = F.when(F.col("present") > 3, F.least(5 * F.coalesce("percentage", F.lit(0.0)), F.lit(30.0))).otherwise(0.0)
    flat = F.when(F.col("variance") < VARIANCE_LIMIT, 20.0).otherwise(0.0)
    return both.select(*keys, "feature", F.greatest(100 - F.least(2 * gone, F.lit(50.0)) - odd - flat, F.lit(0.0)).alias("score"))


def overall_score(miss: Column, outlier_percent: Column, pairs: Column, flat: Column, valid: Column) -> Column:
    less = F.least(2 * miss, F.lit(30.0)) + F.least(5 * outlier_percent, F.lit(20.0)) + F.least(2.0 * pairs, F.lit(20.0)) + F.least(5.0 * flat, F.lit(20.0)) + F.when(valid, 0.0).otherwise(10.0)
    return F.greatest(100 - less, F.lit(0.0))


#: Wordings of recommendations and of the error of an empty input; fixed values.
MUCH_MISSING, MANY_OUTLIERS = "High missing data in features: %s", "Significant outliers in: %s"
CORRELATED, FLAT = "Remove highly correlated features (%s pairs found)", "Remove %s zero-variance features"
UNSOUND, LOW, EMPTY = "Fix data integrity issues", "Overall quality needs improvement", "Empty dataframe"


def _advice(low: float) -> Column:
    """At most five recommendations; those on features name the first three in column order."""
    said = lambda words, what, asked: F.when(asked, F.format_string(words, what))
    few = lambda names: F.concat_ws(", ", F.slice(names, 1, 3))
    gone, odd = F.col("missing_analysis.critical_missing_features"), F.map_keys("outlier_analysis.critical_outlier_features")
    pairs, flat = F.size("correlation_analysis.highly_correlated_pairs"), F.col("variance_analysis.zero_variance_count")
    asked = F.array(
        said(MUCH_MISSING, few(gone), F.size(gone) > 0), said(MANY_OUTLIERS, few(odd), F.size(odd) > 0),
        said(CORRELATED, pairs.cast("string"), pairs > 0), said(FLAT, flat.cast("string"), flat > 0),
        F.when(~F.col("data_integrity.is_valid"), UNSOUND), F.when(F.col("overall_quality_score") < low, LOW),
    )
    return F.slice(F.filter(asked, lambda x: x.isNotNull()), 1, 5)


def assembled(names: list[str], keys: tuple[str, ...], gone: DataFrame, held: DataFrame, found: DataFrame, correlated: DataFrame, whole: DataFrame, low: float) -> DataFrame:
    """One report for each of keys from its parts: missing, moments, outliers, correlation and integrity; names: the features in column order."""
    kept = held.where("present > 0")
    place = F.array_position(F.array(*map(F.lit, names)), F.col("feature")).alias("place")
    in_order = lambda when, x: F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct(place, "feature", x.alias("x"))))), lambda e: F.struct(e["feature"], e["x"])))
    odd = found.where("present > 0").groupBy(*keys).agg(
        F.sum("count").alias("n"), F.sum("present").alias("cells"),
        in_order(F.col("count") > 0, F.col("count")).alias("features"),
        in_order(F.col("percentage") > OUTLIER_LIMIT, F.struct("count", "percentage", "max_zscore")).alias("critical"),
    )
    scores = feature_scores(kept, found, keys).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "score")))).alias("feature_quality_scores"))
    whole = whole.drop("rows")
    issues = F.filter(F.array(*(F.struct(F.lit(n).alias("type"), F.col(n).alias("count"), (100 * F.col(n) / F.col("total_rows")).alias("percentage")) for n in INTEGRITY)), lambda x: x["count"] > 0)
    joined = gone.withColumnRenamed("rows", "total_rows")
    for part in (odd, correlated, low_variance(kept, keys), whole, scores):
        joined = joined.join(part, list(keys), "left")
    report = joined.select(
        *keys, "total_rows", "total_features",
        F.struct("total_missing", "missing_percentage", "features_with_missing", "critical_missing_features").alias("missing_analysis"),
        F.struct(F.coalesce("n", F.lit(0)).alias("total_outliers"), F.col("features").alias("outlier_features"), F.col("critical").alias("critical_outlier_features")).alias("outlier_analysis"),
        F.struct("highly_correlated_pairs", "max_correlation").alias("correlation_analysis"),
        F.struct("low_variance_features", "zero_variance_count").alias("variance_analysis"),
        F.struct(issues.alias("integrity_issues"), "is_valid").alias("data_integrity"), "feature_quality_scores",
        overall_score(F.col("missing_percentage"), F.coalesce(100 * F.col("n") / F.when(F.col("cells") > 0, F.col("cells")), F.lit(0.0)), F.size("highly_correlated_pairs"), F.col("zero_variance_count"), F.col("is_valid")).alias("overall_quality_score"),
    )
    return report.withColumn("recommendations", _advice(low)).withColumn("low_quality", F.col("overall_quality_score") < low)


def check_quality(df: DataFrame, rows: int = 1000, low: float = 70.0, wanted: DataFrame | None = None) -> DataFrame:
    """One report a series, over its newest rows; low_quality where the overall score is below `low`.

    The newest rows, `rows` a series, are written once, as every part of the report reads them.  Series of
    `wanted` (KEY) without rows get a report of score 0 with an error; without it, no rows give no report.
    """
    sample = settled(newest(df, rows))
    names = numeric_columns(sample)
    held = moments(sample)
    found = outliers(sample, held)
    report = assembled(names, KEY, missing(sample), held, found, correlation(sample), integrity(sample), low).drop("low_quality")
    if wanted is not None:
        report = wanted.select(*KEY).distinct().join(report, list(KEY), "left")
    report = report.withColumn("error", F.when(F.col("total_rows").isNull(), EMPTY)).fillna({"total_rows": 0, "total_features": 0, "overall_quality_score": 0.0})
    return report.withColumn("low_quality", F.col("overall_quality_score") < low)
