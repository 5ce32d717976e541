"""Edges of cleaning, windows, timeframes, plans, messages and tables."""

from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.functions.times import interval_ms
from tickforge.jobs import incremental
from tickforge.operators import bars, clean, features, indicators, plans, quality, timeframes
from tickforge.schema import KLINE, VALUES
from tickforge.sources import messages, tables
from tickforge.sources.scratch import scratch_path

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def klines(spark, closes, symbol="A", interval="1h", step=60, volume=10.0, **other):
    rows = []
    for i, c in enumerate(closes):
        r = {"symbol": symbol, "interval": interval, "timestamp": T0 + timedelta(minutes=step * i), "open": c, "high": c if c is None else c + 1, "low": c if c is None else c - 1, "close": c, "volume": volume, "quote_volume": 1.0, "trades": 3, "taker_buy_volume": 4.0, "taker_buy_quote_volume": 1.0, "is_closed": True}
        rows.append(tuple((r | {k: v[i] for k, v in other.items()})[c] for c in KLINE.names))
    return spark.createDataFrame(rows, KLINE)


def column(df, name):
    return [r[name] for r in df.orderBy("timestamp").collect()]


def test_minimum_history_and_gates(spark):
    for n in (19, 20, 21):
        got = features.features(klines(spark, [100.0 + i % 7 for i in range(n)]))
        assert got.count() == (n if n >= 20 else 0)
        if n >= 20:
            assert (column(got, "bb_middle")[-1] is not None) == (n > 20) and (column(got, "cci_20")[-1] is not None) == (n > 20)
    assert column(got, "price_position")[0] == 0.5 and column(got, "sharpe_ratio_20")[0] == 0 and column(got, "bb_percent")[0] == 0.5


def test_constant_price_and_zero_volume(spark):
    flat = features.features(klines(spark, [5.0] * 40, volume=0.0)).orderBy(F.col("timestamp").desc()).first()
    assert flat["bb_percent"] == 0.5 and flat["sharpe_ratio_20"] == 0 and flat["vwap"] is None and flat["volume_ratio"] is None and flat["kyle_lambda"] is None and flat["mfi_14"] == 0 and flat["rsi_14"] == 0


def test_null_only_while_in_the_window(spark):
    closes = [float(i) for i in range(40)]
    closes[5] = None
    got = column(indicators.finite_features(klines(spark, closes)), "sma_10")
    assert got[14] is None and got[15] is not None and all(x is None for x in got[5:15])


def test_clean_fills_both_ways_and_streams_only_forward(spark):
    df = klines(spark, [None, float("nan"), 3.0, None, float("inf"), 6.0])
    assert column(clean.clean_ohlcv(df), "close") == [3.0, 3.0, 3.0, 3.0, 3.0, 6.0]
    assert column(clean.clean_ohlcv(df, backfill=False), "close") == [None, None, 3.0, 3.0, 3.0, 6.0]
    with pytest.raises(ValueError, match="close"):
        clean.require_columns(df.drop("close"))


def test_series_are_isolated_and_partitioning_does_not_matter(spark):
    a, b = klines(spark, [100.0 + (i * 7) % 11 for i in range(60)]), klines(spark, [50.0 - i % 5 for i in range(60)], symbol="B")
    alone = {r["timestamp"]: [r[c] for c in VALUES] for r in features.features(a).collect()}
    both = {r["timestamp"]: [r[c] for c in VALUES] for r in features.features(a.unionByName(b).repartition(7)).where("symbol = 'A'").collect()}
    assert alone == both


def test_one_exchange_for_all_features(spark):
    plan = features.features(klines(spark, [1.0] * 30).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1


def test_blocks_equal_whole_series(spark):
    a = "CASE WHEN id % 977 = 5 THEN NULL ELSE 100 + (id * 7919 % 1013) / 50 + 10 * sin(id / 300) END"
    held = spark.range(9500).selectExpr(
        "CASE WHEN id < 9400 THEN 'A' WHEN id < 9415 THEN 'B' ELSE 'C' END AS symbol", "'1h' AS interval", "timestamp_seconds(3600 * (id + 700 * (id div 2500)) - 5000000) AS timestamp", f"{a} AS close", f"{a} + id % 3 AS high",
        f"{a} - id % 4 AS low", "100D AS open", "CASE WHEN id % 601 = 7 THEN NULL ELSE double(id % 17) END AS volume", "double(id % 5) AS taker_buy_volume",
    )
    whole, cut = (x.orderBy("symbol", "timestamp").toPandas() for x in (features.features(held), features.features_blocked(held, block=3000, halo=2900)))
    assert cut["symbol"].value_counts().to_dict() == {"A": 9400, "C": 85} and list(cut.columns) == list(whole.columns) and (cut[["symbol", "timestamp"]] == whole[["symbol", "timestamp"]]).all().all()
    for c in VALUES:
        assert cut[c].to_numpy(float) == pytest.approx(whole[c].to_numpy(float), rel=1e-9, abs=1e-9, nan_ok=True), c
    assert features.features_blocked(held.limit(0)).count() == 0
    with pytest.raises(ValueError, match="halo"):
        features.features_blocked(held, block=100, halo=50)


def test_places_count_rows_of_gaps_and_repeats(spark):
    from tickforge.operators.blocks import in_blocks, placed

    k = klines(spark, [1.0] * 25).withColumn("timestamp", F.expr("timestamp + make_interval(0, 0, 0, 0, CASE WHEN hour(timestamp) > 8 THEN 400 ELSE 0 END)"))
    got = placed(k.unionByName(k.where(F.hour("timestamp") == 3)), 4).collect()
    assert sorted(r["place"] for r in got) == list(range(len(got))) and {r["total"] for r in got} == {len(got)}
    assert [r["place"] for r in sorted(got, key=lambda r: (r["timestamp"], r["place"]))] == list(range(len(got)))
    dealt = in_blocks(k, 10, 4).collect()
    assert {of: (sum(r["own"] for r in dealt if r["of"] == of), sum(not r["own"] for r in dealt if r["of"] == of)) for of in range(3)} == {0: (10, 0), 1: (10, 4), 2: (5, 4)} and len(dealt) == 33


def test_asof_takes_whole_rows_with_their_nulls(spark):
    base = klines(spark, [1.0, 2.0, 3.0, 4.0], step=60 * 12).select("symbol", "timestamp", "close")
    other = spark.createDataFrame([("A", T0 + timedelta(hours=10), 7.0), ("A", T0 + timedelta(hours=20), None), ("B", T0, 9.0)], "symbol string, timestamp timestamp, x double")
    for by_day in (True, False):
        got = timeframes.asof_backward(base, {"o": other}, by_day).orderBy("timestamp").collect()
        assert [(r["o"] is not None, r["o"] and r["o"]["x"]) for r in got] == [(False, None), (True, 7.0), (True, None), (True, None)]


def test_multi_timeframe_names(spark):
    hour, odd = (klines(spark, [1.0, 2.0], interval=i).select("symbol", "interval", "timestamp", "close") for i in ("1h", "odd"))
    got = timeframes.multi_timeframe({"odd": odd, "1h": hour})
    assert got.columns == ["symbol", "timestamp", "close", "close_odd"] and got.count() == 2  # an unknown name counts as an hour there
    assert timeframes.multi_timeframe({"1h": hour.limit(0), "4h": hour}).count() == 0


def test_close_time_hides_unfinished_bars(spark):
    hour = klines(spark, [float(i) for i in range(8)]).select("symbol", "interval", "timestamp", "close")
    four = klines(spark, [10.0, 20.0], interval="4h", step=240).select("symbol", "interval", "timestamp", "close")
    got = timeframes.multi_timeframe({"1h": hour, "4h": four}, use_close_time=True)
    assert column(got, "close_4h") == [None] * 3 + [10.0] * 4 + [20.0]


def test_blocks_leave_out_a_partial_tail(spark):
    df = klines(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    assert column(bars.downsample_blocks(df, 2), "close") == [2.0, 4.0]
    assert bars.downsample_blocks(df, 1) is df


def test_interval_names(spark):
    rows = spark.createDataFrame([("1m",), ("1M",), ("odd",), (None,)], "i string").select(interval_ms("i")).collect()
    assert [r[0] for r in rows] == [60_000, 2_592_000_000, 60_000, 60_000]


def test_messages_that_are_not_klines(spark):
    rest = spark.createDataFrame([("A", "1h", "[[1704067200000,\"1\",\"2\",\"0.5\",\"x\",\"9\",0,\"3\",4,\"5\",\"6\",\"0\"]]"), ("A", "1h", "no json"), ("A", "1h", None), ("A", "1h", "[[]]")], "symbol string, interval string, value string")
    got = messages.parse_rest_klines(rest).collect()
    assert len(got) == 1 and got[0]["close"] is None and got[0]["open"] == 1.0 and got[0]["trades"] == 4 and got[0]["is_closed"]
    ws = spark.createDataFrame([("btc@kline_1h", '{"e":1}'), ("btc@kline_1h", "x"), ("btc@kline_1h", None), ("btc@kline_1h", '{"k":{"t":1704067200000,"c":"5","C":"7","x":false}}')], "stream string, value string")
    got = messages.parse_ws_klines(ws).collect()
    assert [(r["symbol"], r["interval"], r["close"], r["is_closed"]) for r in got] == [("BTC", "1h", 5.0, False)]
    bus = spark.createDataFrame([("kline:A:1h", "{}"), ("kline:A", "{}"), ("other:A:1h", '{"timestamp":1,"close":1}')], "key string, value string")
    assert messages.message_to_kline(bus).count() == 0


def test_line_protocol_escapes_and_skips(spark):
    df = spark.createDataFrame([("A B", 1.5, None, "q\"x", T0), ("C", None, None, None, T0), ("D", 1.0, 2, "y", None), ("E", float("nan"), 3, None, T0)], "symbol string, a double, n long, s string, timestamp timestamp")
    assert [r[0] for r in messages.to_line_protocol(df, "m").collect()] == ['m,symbol=A\\ B a=1.5,s="q\\"x" 1704067200000000000', "m,symbol=E n=3i 1704067200000000000"]


def test_table_upserts_touch_only_their_days(spark):
    path = scratch_path(spark, "table")
    tables.upsert_table(spark, path, klines(spark, [1.0] * 48))
    before = {r["f"] for r in tables.read_table(spark, path).where("date = '2024-01-01'").select(F.input_file_name().alias("f")).collect()}
    tables.upsert_table(spark, path, klines(spark, [None] * 30 + [9.0]).where("close is not null"))
    held = tables.read_table(spark, path)
    assert held.count() == 48 and held.where("close = 9").count() == 1
    assert before == {r["f"] for r in held.where("date = '2024-01-01'").select(F.input_file_name().alias("f")).collect()}


def test_upsert_defines_repeated_incoming_keys(spark):
    path, b = scratch_path(spark, "table"), klines(spark, [1.0, 2.0, 3.0])
    more = b.withColumn("close", F.col("close") + 5)
    for batch in (b.unionByName(more), more.unionByName(b)):
        tables.upsert_table(spark, path, batch)
        assert column(tables.read_table(spark, path), "close") == [6.0, 7.0, 8.0]


def test_cleaning_is_linear_in_a_series(spark):
    """500,000 rows of one series, with nulls to fill both ways."""
    df = spark.range(500_000).select(F.lit("a").alias("symbol"), F.lit("1m").alias("interval"), F.timestamp_seconds("id").alias("timestamp"), *(F.when(F.col("id") % 7 == 6, F.col("id").cast("double")).alias(c) for c in ("open", "high", "low", "close", "volume")))
    began = time.time()
    got = clean.clean_ohlcv(df).agg(F.count("close").alias("n"), F.min("close").alias("least")).first()
    assert (got["n"], got["least"]) == (500_000, 6.0) and time.time() - began < 30


def test_lookback_reads_near_days_and_whole_short_series(spark):
    path = scratch_path(spark, "table")
    long, gappy = klines(spark, [float(k) for k in range(300)]), klines(spark, [1.0, 2.0, 3.0, 4.0], "B", step=60 * 50)
    tables.upsert_table(spark, path, long.unionByName(gappy))
    table = tables.read_table(spark, path)
    new = long.orderBy(F.col("timestamp").desc()).limit(2).unionByName(gappy.orderBy(F.col("timestamp").desc()).limit(1))
    got = tables.lookback_rows(table, new, 30)
    assert got.where("symbol = 'B'").count() == 4 and 31 <= got.where("symbol = 'A'").count() < 120
    assert tables.lookback_rows(table, new.limit(0), 30).count() == 0


def test_backfill_equals_one_run_over_everything(spark):
    out, b = scratch_path(spark, "features"), klines(spark, [10.0 + k * 7 % 11 for k in range(90)])
    early = b.where(F.col("timestamp") < F.lit(T0 + timedelta(hours=40)))
    assert [incremental.backfill_features(x, out).count() for x in (early.limit(0), early, b, b)] == [0, 1, 1, 0]
    want = {r["timestamp"]: r for r in features.features(b).collect()}
    got = {r["timestamp"]: r for r in incremental.stored_features(spark, out).collect()}
    assert set(got) == set(want) and all(got[t][c] == want[t][c] or got[t][c] == pytest.approx(want[t][c], rel=1e-9) for t in want for c in VALUES if want[t][c] is not None)
    short = scratch_path(spark, "features")
    incremental.backfill_features(early, short)
    incremental.backfill_features(b, short, lookback=30)
    held = {r["timestamp"]: r for r in incremental.stored_features(spark, short).collect()}
    assert set(held) == set(want) and held[max(want)]["sma_20"] == pytest.approx(want[max(want)]["sma_20"]) and held[max(want)]["sma_100"] is None


def test_monotonic_bars_go_by_arrival(spark):
    from tickforge.streaming import jobs

    source, out, state = (scratch_path(spark, n) for n in ("source", "kept", "state"))
    b = klines(spark, [float(k) for k in range(6)])
    order = {0: 0, 2: 1, 1: 2, 3: 3, 5: 4, 4: 5}
    seq = F.element_at(F.create_map(*(F.lit(x) for pair in order.items() for x in pair)), F.col("close").cast("int"))
    arrived = b.withColumn("seq", seq)
    for part in (arrived.where("seq < 2"), arrived.where("seq >= 2")):
        part.write.mode("append").parquet(source)
        jobs.monotonic_bars(spark.readStream.schema(arrived.schema).parquet(source), "seq").writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    assert column(spark.read.parquet(out), "close") == [0.0, 2.0, 3.0, 5.0]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as S

    far = S(conf=S(get=lambda *_: None), sparkContext=S(getConf=lambda: S(get=lambda *_: None), master="spark://far:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_path(far, "x")


def test_zone_of_the_session_is_left_alone(spark, tiny):
    from tickforge.jobs import catalog

    held = spark.conf.get("spark.sql.session.timeZone")
    want = catalog.queries()["time_range"](spark, tiny).toPandas().sort_values("symbol", ignore_index=True)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = catalog.queries()["time_range"](spark, tiny)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo" and got.toPandas().sort_values("symbol", ignore_index=True).equals(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


def test_resume_after_all_is_done(spark):
    b = klines(spark, [1.0] * 30)
    done = plans.resume_plan(b, b).first()
    assert done["status"] == "up_to_date" and done["start"] > done["last"]


def test_quality_of_bad_tables(spark):
    n = 30
    df = klines(spark, [float(i % 9) for i in range(n)], high=[-1.0] * n).select("symbol", "interval", "timestamp", "open", "high", "low", "close", "volume").withColumn("feature_version", F.lit(2))
    report = quality.check_quality(df).first()
    kinds = {i["type"] for i in report["data_integrity"]["integrity_issues"]}
    assert {"high_less_than_low", "negative_high"} <= kinds and not report["data_integrity"]["is_valid"]
    assert report["variance_analysis"]["zero_variance_count"] == 2 and report["correlation_analysis"]["max_correlation"] > 0.99
    assert quality.check_quality(df.limit(0)).count() == 0
    empty = quality.check_quality(df.limit(0), wanted=df).first()
    assert (empty["overall_quality_score"], empty["total_rows"], empty["error"], empty["low_quality"]) == (0.0, 0, "Empty dataframe", True)


def test_upsert_table_keeps_rows_of_more_than_10000_folders(spark, monkeypatch):
    """Rows are looked at where they would be written, as 10,200 folders take minutes to write."""
    read, path, seen = type(spark.read).parquet, scratch_path(spark, "many"), []
    days = spark.range(10_200).select(F.lit("a").alias("symbol"), F.lit("1d").alias("interval"), F.timestamp_seconds(F.col("id") * 86400).alias("timestamp"))
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: days.withColumn("date", F.to_date("timestamp")) if paths == (path,) else read(self, *paths))
    monkeypatch.setattr(tables, "write_table", lambda df, *_: seen.extend(df.groupBy("symbol").count().collect()))
    tables.upsert_table(spark, path, days.withColumn("symbol", F.lit("b")))
    assert sorted(map(tuple, seen)) == [("a", 10_200), ("b", 10_200)]


def test_upsert_table_leaves_other_folders(spark):
    path = scratch_path(spark, "table")

    def made(rows):
        return spark.createDataFrame(rows, "symbol string, interval string, t string, close double").select("symbol", "interval", F.to_timestamp("t").alias("timestamp"), "close")

    rows = [("a", i, f"2024-01-0{d} 01:00:00", float(d)) for i in ("1h", "1d") for d in range(1, 6)]
    new = [("b", "1h", "2024-01-02 01:00:00", 9.0), ("a", "1d", "2024-01-04 01:00:00", 8.0), ("a", "1d", None, 7.0)]
    for batch in (rows, new, [("b", "1d", None, 6.0)]):
        tables.upsert_table(spark, path, made(batch))
    got = spark.read.parquet(path).select("symbol", "interval", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "close").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [r for r in rows if r[:3] != new[1][:3]] + new + [("b", "1d", None, 6.0)]))


def test_stream_gives_features_of_every_new_bar(spark):
    from tickforge.streaming import jobs

    (source, table, out, state), lookback = (scratch_path(spark, n) for n in ("source", "held", "live", "state")), 25
    whole = klines(spark, [10.0 + (i * 7 % 11) for i in range(40)], "A@1").unionByName(klines(spark, [20.0 + (i * 5 % 13) for i in range(31)], "B")).coalesce(1).persist()
    cut = F.col("timestamp") < F.lit(T0 + timedelta(hours=23))
    for part in (whole.where(cut), whole.where(~cut)):
        part.write.mode("append").parquet(source)
        jobs.stream_features(spark.readStream.schema(KLINE).parquet(source), table, out, state, lookback, None).awaitTermination()
    got = {(r["symbol"], r["timestamp"]): r for r in spark.read.parquet(out).collect()}
    times = [r["timestamp"] for r in whole.where("symbol = 'A@1'").orderBy("timestamp").collect()]
    assert set(got) == {("A@1", t) for t in times[19:]} | {("B", t) for t in times[19:31]}
    for k in (19, 22, 23, 24, 30, 39):
        for r in features.features_latest(whole.where(F.col("timestamp") <= F.lit(T0 + timedelta(hours=k))), lookback).collect():
            if (r["symbol"], times[k]) in got and r["timestamp"] == times[k]:
                assert [got[r["symbol"], times[k]][c] for c in VALUES] == [r[c] if r[c] is None else pytest.approx(r[c], rel=1e-9) for c in VALUES]


def test_all_intervals_come_from_one_exchange_by_day(spark, tiny):
    from tickforge.jobs import adapter
    from tickforge.operators import bars

    made = bars.bars_of_all_intervals(adapter.trades(spark, tiny))
    made.write.format("noop").mode("overwrite").save()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == len(bars.LADDER)  # the same one, which is run once and reused
    counts = {r["interval"]: r["n"] for r in made.groupBy("interval").agg(F.sum("trades").alias("n")).collect()}
    assert set(counts) == set(bars.LADDER) and len(set(counts.values())) == 1
    assert [bars.parent_interval(i, bars.LADDER) for i in ("3m", "15m", "4h", "6h", "8h", "1d")] == ["1m", "5m", "2h", "2h", "4h", "12h"]
    for wrong in (("1m", "1w"), ("3m", "5m")):
        with pytest.raises(ValueError):
            bars.bars_of_all_intervals(adapter.trades(spark, tiny), wrong)


def test_calculators_share_the_one_exchange(spark):
    from tickforge.functions.windows import series

    df = klines(spark, [10.0 + i % 7 for i in range(60)])
    own = features.Calculator({"before": F.lag("close").over(series())}, lambda h, l, c: {"seen": np.cumsum(c)}, ("seen",))  # noqa: E741
    found = features.features(df, calculators=(own, features.Calculator({"twice": 2 * F.col("sma_10")})))
    assert found.columns[-3:] == ["before", "seen", "twice"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = found.orderBy("timestamp").collect()
    assert rows[5]["before"] == rows[4]["close"] and rows[5]["seen"] == sum(r["close"] for r in rows[:6]) and rows[20]["twice"] == 2 * rows[20]["sma_10"]
    with pytest.raises(ValueError, match="ema_10"):
        features.features(df, calculators=(features.Calculator({"ema_10": F.col("close")}),))
