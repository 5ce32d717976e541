"""Recursions and features that go on from states, and what a run reads."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge.functions import carried as C
from tickforge.functions.recursive import recursive_columns
from tickforge.jobs import incremental
from tickforge.operators.carried import LOOKBACK, STATES, features_carried, new_states
from tickforge.operators.features import features
from tickforge.schema import KEY, RECURSIVE, VALUES
from tickforge.sources import tables
from tickforge.sources.scratch import scratch_path


def walk(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(size=n))
    return close + rng.random(n), close - rng.random(n), close


@settings(max_examples=25, deadline=None)
@given(st.integers(201, 400), st.lists(st.integers(1, 120), min_size=1, max_size=4), st.integers(0, 10**6))
def test_steps_from_states_equal_the_whole(first, steps, seed):
    h, l, c = walk(first + sum(steps), seed)  # noqa: E741
    want = recursive_columns(h, l, c)
    found, state = C.carried_columns(h[:first], l[:first], c[:first])
    at = first
    for n in steps:
        skip = 1 + seed % 7
        lo = at - skip
        more, state = C.carried_columns(h[lo : at + n], l[lo : at + n], c[lo : at + n], skip, state)
        found = {k: np.concatenate([found[k], more[k]]) for k in found}
        at += n
    for k in RECURSIVE:
        np.testing.assert_allclose(found[k], want[k], rtol=1e-12, atol=1e-9, equal_nan=True)


def test_maps_of_blocks_compose():
    h, l, c = walk(1000)  # noqa: E741
    cuts = [0, 300, 301, 640, 1000]
    want = C.first_level(h, l, c)
    ends = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        skip = min(lo, 1)
        ends.append(C.first_level(h[lo - skip : hi], l[lo - skip : hi], c[lo - skip : hi], skip, None if lo == 0 else np.zeros(len(C.FIRST_LEVEL)))[:, -1])
    got = C.composed(np.diff(cuts), np.stack(ends), C.FIRST_ALPHAS)
    for b, lo in enumerate(cuts[1:-1], 1):
        np.testing.assert_allclose(got[b], want[:, lo - 1], rtol=1e-12)


def bars(spark, sizes: dict[str, int], gaps: bool = False):
    rows = []
    for k, (symbol, n) in enumerate(sizes.items()):
        h, l, c = walk(n, k + 1)  # noqa: E741
        rng = np.random.default_rng(k)
        hours = np.cumsum(rng.integers(1, 4, n)) if gaps else np.arange(n)
        rows.append(pd.DataFrame({"symbol": symbol, "interval": "1h", "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(hours, unit="h"), "open": c, "high": h, "low": l, "close": c, "volume": rng.integers(1, 90, n).astype(float), "taker_buy_volume": 1.0}))
    return spark.createDataFrame(pd.concat(rows))


def compare(got, want):
    columns = [*KEY, "timestamp", *VALUES]
    a, b = (x.select(columns).toPandas().sort_values(columns[:3], ignore_index=True) for x in (got, want))
    assert len(a) == len(b)
    for c in columns[:3]:
        assert (a[c] == b[c]).all()
    for c in VALUES:
        np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, atol=1e-7, equal_nan=True, err_msg=c)


@pytest.mark.parametrize("block", [256, 131_072])
def test_one_run_without_states_equals_features(spark, block):
    b = bars(spark, {"a": 900, "b": 40, "c": 19, "d": 200, "e": 513}, gaps=True)
    found = features_carried(b, spark.createDataFrame([], STATES), block=block)
    compare(found, features(b))
    states = new_states(found).toPandas().set_index("symbol")
    assert states["bars"].to_dict() == {"a": 900, "b": 40, "d": 200, "e": 513}
    times = {s: g["timestamp"].sort_values().tolist() for s, g in b.toPandas().groupby("symbol")}
    assert all(states.loc[s, "timestamp"] == times[s][-1] and states.loc[s, "since"] == times[s][max(0, len(times[s]) - LOOKBACK)] for s in states.index)


@pytest.mark.parametrize("block", [256, 131_072])
def test_runs_go_on_and_read_new_bars_and_lookback_only(spark, block):
    """Series that grow by a bar, by many (more than a block), that ripen between runs, that are new, and that rest."""
    sizes = {"a": 1500, "b": 420, "c": 260, "new": 300, "rests": 240}
    b = bars(spark, sizes, gaps=True).withColumn("place", F.row_number().over(tables.Window.partitionBy(*KEY).orderBy("timestamp")))
    held, out, state = (scratch_path(spark, n) for n in ("klines", "features", "states"))
    seen = {s: 0 for s in sizes}
    runs = [{"a": 400, "b": 250, "c": 100, "rests": 240}, {"a": 401, "b": 300, "c": 199, "rests": 240}, {"a": 1200, "b": 300, "c": 201, "new": 300, "rests": 240}, {"a": 1500, "b": 420, "c": 260, "new": 300, "rests": 240}]
    for upto in runs:
        part = b.join(spark.createDataFrame(list(upto.items()), "symbol string, most long"), "symbol").where(F.col("place") <= F.col("most")).drop("place", "most")
        tables.write_table(part, held, "overwrite")
        klines = tables.read_table(spark, held)
        known, _ = incremental.read_states(spark, state)
        read = incremental.carried_rows(klines, incremental.carry_plan(klines, known)).groupBy("symbol").count().toPandas().set_index("symbol")["count"].to_dict()
        assert read == {s: n - seen[s] + (LOOKBACK if seen[s] >= LOOKBACK else seen[s]) for s, n in upto.items() if n > seen[s]}
        plan = incremental.carry_features(klines, out, state, block=block)
        assert {r["symbol"] for r in plan.collect()} == set(read)
        seen |= upto
    compare(incremental.stored_features(spark, out), features(b))
    assert incremental.carry_features(tables.read_table(spark, held), out, state).count() == 0


def test_a_run_that_died_before_its_states_is_done_again(spark):
    b = bars(spark, {"a": 600})
    out, state = scratch_path(spark, "features"), scratch_path(spark, "states")
    early = b.where(F.col("timestamp") < F.to_timestamp(F.lit("2024-01-15")))
    incremental.carry_features(early, out, state)
    known, run = incremental.read_states(spark, state)
    assert run == 1
    tables.upsert_table(spark, out, features(b).where(F.col("timestamp") < F.to_timestamp(F.lit("2024-01-18"))).withColumn("close", F.lit(-1.0)))  # half a run, whose states never came
    incremental.carry_features(b, out, state)
    late = F.col("timestamp") >= F.to_timestamp(F.lit("2024-01-15"))
    compare(incremental.stored_features(spark, out).where(late), features(b).where(late))


def test_folders_of_other_intervals_and_older_dates_are_not_read(spark):
    hourly = bars(spark, {"a": 2000})
    daily = hourly.where(F.hour("timestamp") == 0).withColumn("interval", F.lit("1d"))
    path = scratch_path(spark, "klines")
    tables.write_table(hourly.unionByName(daily), path)
    table = tables.read_table(spark, path)
    firsts = spark.createDataFrame([("1h", datetime(2024, 3, 20)), ("1d", datetime(2024, 2, 1))], "interval string, first timestamp")
    near = tables.since_by_interval(table, firsts)
    held = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = near._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", held)
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "1h" in filters and "2024-03-20" in filters and "2024-02-01" in filters
    assert near.groupBy("interval").agg(F.min("date").cast("string").alias("d")).toPandas().set_index("interval")["d"].to_dict() == {"1h": "2024-03-20", "1d": "2024-02-01"}


def test_lookback_of_daily_and_hourly_series(spark):
    """Series with gaps and short ones are found further back, and what is read of an interval doesn't depend on others."""
    hourly, gappy = bars(spark, {"a": 1500}), bars(spark, {"g": 600}, gaps=True).where("hour(timestamp) % 11 = 3")
    daily = hourly.where(F.hour("timestamp") == 0).withColumn("interval", F.lit("1d")).withColumn("symbol", F.lit("day"))
    path = scratch_path(spark, "klines")
    tables.write_table(hourly.unionByName(gappy).unionByName(daily), path)
    table = tables.read_table(spark, path)
    new = table.groupBy(*KEY).agg(F.max("timestamp").alias("timestamp"))
    got = tables.lookback_rows(table, new, 30).groupBy("symbol").agg(F.count("*").alias("n"), F.min("timestamp").alias("t")).toPandas().set_index("symbol")
    assert (got["n"] >= 30).all() and got.loc["a", "n"] <= 85 and got.loc["a", "t"] >= pd.Timestamp("2024-02-28")
    assert got.loc["g", "n"] < gappy.count() or gappy.count() < 200


def test_a_day_is_written_by_many_tasks_and_untouched_slots_keep_their_files(spark, tmp_path):
    path = f"{tmp_path}/klines"
    day = spark.range(4000).select(F.format_string("s%03d", (F.col("id") % 100).cast("int")).alias("symbol"), F.lit("1m").alias("interval"), F.timestamp_micros(1_704_067_200_000_000 + F.col("id") * 20_000_000).alias("timestamp"), F.col("id").cast("double").alias("close"))
    tables.write_table(day, path, slot_rows=1000)
    files = lambda: {str(p.relative_to(path)) for p in tmp_path.rglob("*.parquet") if "_ranges" not in str(p)}
    first = files()
    folders = {f.rsplit("/", 1)[0] for f in first}
    assert folders == {f"interval=1m/date=2024-01-01/slot={k}" for k in range(4)} and len(first) == 4
    assert sorted(r["n"] for r in tables.read_table(spark, path).groupBy("slot").agg(F.count("*").alias("n")).collect()) == [1000] * 4
    new = day.where("symbol = 's030' and close < 500").withColumn("close", F.lit(-1.0)).unionByName(day.where("close = 0").withColumn("symbol", F.lit("s030a")))
    tables.upsert_table(spark, path, new, slot_rows=1000)
    later = files()
    assert {f for f in first if "slot=1/" not in f} == {f for f in later if "slot=1/" not in f} and first != later
    got = tables.read_table(spark, path)
    assert got.count() == 4001 and got.where("close = -1").count() == new.count() - 1 and got.where("symbol = 's030a' and slot = 1").count() == 1
    tables.upsert_table(spark, path, new.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day")).withColumn("interval", F.lit(None).cast("string")))
    assert tables.read_table(spark, path).where("interval is null").count() == new.count()
    assert tables.read_ranges(spark, path)[0].count() == 5
