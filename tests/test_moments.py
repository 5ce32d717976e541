"""Moments that merge, and quality reports from states."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge.functions.moments import Moments
from tickforge.operators import quality, quality_state


def table(rows: int, seed: int, missing: float = 0.2, base: float = 1e6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = base + rng.normal(size=(rows, 6))
    x[:, 1] = 3 * x[:, 0] + rng.normal(size=rows) * 1e-3
    x[:, 4] = 7.0
    x[rng.random(x.shape) < missing] = np.nan
    x[:, 5] = np.nan
    return x


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=6), st.integers(0, 10**6))
def test_parts_merge_to_the_whole_in_any_order(sizes, seed):
    x = table(sum(sizes), seed)
    parts = [Moments.of(p) for p in np.split(x, np.cumsum(sizes)[:-1])]
    merged = parts[0]
    for p in np.random.default_rng(seed).permutation(len(parts) - 1) + 1:
        merged = parts[p].merged(merged) if p % 2 else merged.merged(parts[p])
    merged = Moments.from_bytes(merged.to_bytes(), 6)
    want = pd.DataFrame(x)
    got = merged.correlations()
    for i in range(6):
        for j in range(6):
            both = want[[i, j]].dropna() if i != j else want[[i]].dropna()
            assert merged.n[i, j] == len(both)
            if len(both) > 1 and i != j and both[i].nunique() > 1 and both[j].nunique() > 1:
                assert got[i, j] == pytest.approx(np.corrcoef(both[i] - 1e6, both[j] - 1e6)[0, 1], abs=1e-6)
            elif i != j:
                assert np.isnan(got[i, j])
        np.testing.assert_equal((merged.low[i], merged.high[i]), (want[i].min(), want[i].max()))
        if merged.n[i, i] > 1:
            assert np.diagonal(merged.second)[i] == pytest.approx(want[i].var() * (merged.n[i, i] - 1), rel=1e-6, abs=1e-9)


def features(spark, rows: int):
    rng = np.random.default_rng(3)
    x = table(rows, 5, base=50.0)
    x[rng.integers(0, rows, 3), 2] = 1e4
    names = ["open", "high", "low", "close", "volume", "empty"]
    df = pd.DataFrame(x, columns=names).assign(symbol=np.where(np.arange(rows) % 3 > 0, "hot", "b"), interval="1h", timestamp=pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(rows), unit="min"), feature_version=1)
    df.loc[0, "volume"] = -1.0
    return spark.createDataFrame(df).select("symbol", "interval", "timestamp", *(F.nanvl(F.col(c), F.lit(None)).alias(c) for c in names), "feature_version")


def test_reports_from_states_equal_reports_of_rows(spark, monkeypatch):
    """States of many tasks, flushed early, merge to the reports that all rows give."""
    monkeypatch.setattr(quality_state, "HELD", 0)
    df = features(spark, 900).withColumn("period", F.timestamp_micros(F.lit(0).cast("long"))).repartition(6)
    states = quality_state.merged_states(quality_state.partial_states(df), len(quality.numeric_columns(df)))
    got = quality_state.state_reports(df, states).drop("period").toPandas().sort_values("symbol", ignore_index=True)
    want = quality.check_quality(df.drop("period"), rows=10**6).toPandas().sort_values("symbol", ignore_index=True)
    assert sorted(got.columns) == sorted(c for c in want.columns if c != "error")

    def same(a, b):
        if isinstance(b, float):
            assert a == pytest.approx(b, rel=1e-7, abs=1e-9)
        elif isinstance(b, dict) or hasattr(b, "asDict"):
            a, b = (x if isinstance(x, dict) else x.asDict() for x in (a, b))
            assert list(a) == list(b)
            for k in b:
                same(a[k], b[k])
        elif isinstance(b, list | np.ndarray):
            assert len(a) == len(b)
            for x, y in zip(a, b):
                same(x, y)
        else:
            assert a == b or (a is None) == (b is None)

    for c in got.columns:
        for a, b in zip(got[c], want[c]):
            same(a, b)


def test_a_trigger_that_runs_again_counts_once(spark):
    from tickforge.sources.scratch import scratch_path
    from tickforge.streaming import jobs

    held, states, reports, state, source = (scratch_path(spark, n) for n in ("f", "s", "r", "c", "in"))
    from tickforge.schema import FEATURES

    df = features(spark, 300)
    whole = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in FEATURES.names))
    whole = whole.select(*(F.col(f.name).cast(f.dataType) for f in FEATURES))
    for cut in ("timestamp < timestamp'2024-01-01 02:00:00'", "timestamp >= timestamp'2024-01-01 02:00:00'"):
        whole.where(cut).write.mode("append").parquet(source)
        for checkpoint in (state, scratch_path(spark, "again")) if "<" in cut else (state,):
            jobs.stream_quality(spark.readStream.schema(FEATURES).parquet(source), held, states, reports, checkpoint, every=None).awaitTermination()
    got = jobs.latest_reports(spark.read.parquet(reports)).select("symbol", "total_rows").toPandas().set_index("symbol")["total_rows"].to_dict()
    assert got == {"hot": 200, "b": 100}
