"""The incremental feature jobs: plan, look back, compute, cut out what is new, upsert.

carry_features goes on from a table of states and reads new bars and a fixed lookback;
backfill_features needs no states and reads series with new bars from their start.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import interval_ms
from ..operators.carried import BLOCK, LOOKBACK, STATES, features_carried, new_states
from ..operators.clean import emit_slice
from ..operators.features import features_blocked
from ..operators.plans import resume_plan
from ..schema import FEATURES, KEY
from ..sources.scratch import settled
from ..sources.tables import read_table, since_by_interval, upsert_table


def stored_features(spark: SparkSession, path: str) -> DataFrame:
    """The features under path; none where nothing was written yet."""
    try:
        return read_table(spark, path).select(*FEATURES.names)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], FEATURES)


def backfill_features(klines: DataFrame, out: str, lookback: int | None = None, version: int = 2) -> DataFrame:
    """Upsert the features that a table lacks; the plan of the run (KEY, status, start, last), one row a series with work to do.

    A series goes on behind its last features.  Only series with new bars are read.  lookback: how many
    intervals before the start they are read from; None: from their first bar, so that averages without
    end are those of the whole history, whatever runs came before.  Long series go by blocks.  An empty plan writes nothing.
    """
    spark = klines.sparkSession
    plan = settled(resume_plan(klines, stored_features(spark, out)).where("start <= last").select(*KEY, "status", "start", "last"))
    if plan.isEmpty():
        return plan
    held = klines.join(plan.select(*KEY, "start"), list(KEY))
    if lookback is not None:
        held = held.where(F.unix_micros("timestamp") >= F.unix_micros("start") - lookback * 1000 * interval_ms("interval"))
    found = features_blocked(held.drop("start"), version=version).join(plan.select(*KEY, "start", "last"), list(KEY))
    upsert_table(spark, out, settled(emit_slice(found, F.col("start"), F.col("last")).select(*FEATURES.names)))
    return plan


def read_states(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(the states of the last run under path, its number); none and 0 before the first."""
    try:
        held = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return spark.createDataFrame([], STATES), 0
    run = held.agg(F.max("run")).first()[0]
    return held.where(F.col("run") == run).select(*STATES.names), int(run)


def carry_plan(klines: DataFrame, states: DataFrame, lag: int | None = None) -> DataFrame:
    """(KEY, start, last, since, bars) of series with bars behind their state, or without one (start, since and bars null).

    Of each interval, bars are looked for from the date of its oldest state on, or, with lag, from at most `lag`
    intervals before its newest; of intervals without states everywhere.
    """
    newest = F.timestamp_micros(F.unix_micros(F.max("timestamp")) - 1000 * (lag or 0) * F.max(interval_ms("interval")))
    firsts = settled(states.groupBy("interval").agg((F.min("timestamp") if lag is None else newest).alias("first")))
    recent = since_by_interval(klines, firsts).unionByName(klines.join(F.broadcast(firsts.select("interval")), "interval", "left_anti").select(*klines.columns))  # a row an interval
    met = recent.select(*KEY, "timestamp").join(states.select(*KEY, F.col("timestamp").alias("until"), "since", "bars"), list(KEY), "left")
    fresh = met.where(F.col("until").isNull() | (F.col("timestamp") > F.col("until")))
    return fresh.groupBy(*KEY).agg(F.min(F.when(F.col("until").isNotNull(), F.col("timestamp"))).alias("start"), F.max("timestamp").alias("last"), F.first("since").alias("since"), F.first("bars").alias("bars"))


def carried_rows(klines: DataFrame, plan: DataFrame) -> DataFrame:
    """The bars that a run reads: of series with a state of LOOKBACK bars and more those from its `since` on, of others all."""
    ripe = plan.where(F.col("bars") >= LOOKBACK)
    others = plan.where(F.col("bars").isNull() | (F.col("bars") < LOOKBACK)).select(*KEY)
    near = since_by_interval(klines, ripe.select("interval", F.col("since").alias("first"))).join(ripe.select(*KEY, "since"), list(KEY)).where(F.col("timestamp") >= F.col("since"))
    near = near.select(*klines.columns)
    return near if others.isEmpty() else near.unionByName(klines.join(others, list(KEY), "left_semi").select(*klines.columns))


def carry_features(klines: DataFrame, out: str, states: str, version: int = 2, block: int = BLOCK, lag: int | None = None) -> DataFrame:
    """Upsert the features of all bars behind each series' state, as of the series' whole history, and write the new states; the plan of the run.

    klines: best a table of write_table, whose folders are then pruned by interval and date.  states: a folder with one
    sub-folder a run, each with the state of every series.  Features are written first: a run that dies in between is
    done again from the old states, with the same result.  Series of fewer than 20 bars get no state.
    """
    spark = klines.sparkSession
    known, run = read_states(spark, states)
    plan = settled(carry_plan(klines, known, lag))
    if plan.isEmpty():
        return plan
    found = settled(features_carried(carried_rows(klines, plan), known.join(plan.select(*KEY), list(KEY), "left_semi"), version=version, block=block))
    new = found.join(plan.select(*KEY, "start"), list(KEY)).where(F.col("start").isNull() | (F.col("timestamp") >= F.col("start")))
    upsert_table(spark, out, new.select(*FEATURES.names))
    fresh = new_states(found)
    known.join(fresh.select(*KEY), list(KEY), "left_anti").unionByName(fresh).write.parquet(f"{states}/run={run + 1}")
    return plan
