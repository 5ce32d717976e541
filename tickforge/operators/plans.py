"""What is there and what is to be done: ranges, counts, coverage, and plans of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import interval_ms
from ..schema import KEY


def time_range(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count("*").alias("rows"))


def latest_timestamp(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(F.max("timestamp").alias("last"))


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(F.count("*").alias("rows"))


def null_report(df: DataFrame) -> DataFrame:
    """(column, nulls, percent) of every column, from one aggregation."""
    counts = df.agg(F.count("*").alias("__rows"), *(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns))
    long = counts.unpivot(["__rows"], df.columns, "column", "nulls")
    return long.select("column", "nulls", F.when(F.col("__rows") > 0, 100 * F.col("nulls") / F.col("__rows")).otherwise(0.0).alias("percent"))


def coverage(klines: DataFrame, features: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Rows of klines and of features of each series, progress in percent, and quality score (0 where there is none)."""
    both = row_counts(klines).withColumnRenamed("rows", "klines").join(row_counts(features).withColumnRenamed("rows", "features"), list(KEY), "full_outer")
    both = both.fillna(0, ["klines", "features"])
    scored = both.join(quality.select(*KEY, "overall_quality_score"), list(KEY), "left") if quality is not None else both.withColumn("overall_quality_score", F.lit(0.0))
    return scored.select(
        *KEY, "klines", "features", F.when(F.col("klines") > 0, 100 * F.col("features") / F.col("klines")).otherwise(0.0).alias("progress"),
        (F.col("features") > 0).alias("has_features"), F.coalesce("overall_quality_score", F.lit(0.0)).alias("quality_score"),
    )


def _plus_ms(time: Column, ms: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(time) + ms * 1000)


def resume_plan(klines: DataFrame, features: DataFrame, wanted: DataFrame | None = None, slack: int = 5) -> DataFrame:
    """Where features of each series go on: no_data, from_start, resume or up_to_date, and start.

    Series whose last features are within `slack` bars of the end are up to date; even so, bars
    that are newer than those are still to be done, from `start` on (none: start is past the end).
    """
    have = time_range(klines)
    if wanted is not None:
        have = wanted.select(*KEY).join(have, list(KEY), "left")
    done = latest_timestamp(features).withColumnRenamed("last", "done")
    ms = interval_ms("interval")
    plan = have.join(done, list(KEY), "left")
    status = F.when(F.col("last").isNull(), "no_data").when(F.col("done").isNull(), "from_start").when(F.col("done") >= _plus_ms(F.col("last"), -slack * ms), "up_to_date").otherwise("resume")
    start = F.when(F.col("last").isNotNull(), F.coalesce(_plus_ms(F.col("done"), ms), F.col("first")))
    return plan.select(*KEY, "first", "last", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"), start.alias("start"))


def backfill_plan(spark: SparkSession, klines: DataFrame, symbols: list[str], intervals: list[str], now: Column, days: int = 365, least_ms: int = 60_000) -> DataFrame:
    """What is to be fetched of each wanted series: [start, now), needed where that is longer than least_ms."""
    wanted = spark.createDataFrame([(s, i) for s in symbols for i in intervals], "symbol string, interval string")
    plan = wanted.join(latest_timestamp(klines), list(KEY), "left")
    start = F.coalesce(_plus_ms(F.col("last"), interval_ms("interval")), _plus_ms(now, F.lit(-days * 86_400_000)))
    span = (F.unix_micros(now) - F.unix_micros(start)) / 1000
    return plan.select(*KEY, start.alias("start"), now.alias("end"), (span > least_ms).alias("needed"))
