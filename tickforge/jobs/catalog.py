"""All queries of the library over the given tables, by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bars as make
from ..operators import clean, features, indicators, plans, quality, quality_state, timeframes
from ..schema import AVERAGES, FINITE, VALUES
from ..sources import messages, tables, wire
from ..functions import times
from ..functions.carried import gone_on
from ..sources.scratch import scratch_path, settled
from ..streaming import jobs as streams
from . import adapter, sql
from .incremental import backfill_features, carry_features, stored_features

Query = Callable[[SparkSession, str], DataFrame]

KLINE_VALUES = ("open", "high", "low", "close", "volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")


def _r(c: str | Column, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def _shown(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.select("symbol", "interval", F.unix_micros("timestamp").alias("ts"), *(_r(c, digits).alias(c) for c in columns))


def _klines(df: DataFrame) -> DataFrame:
    return df.select("symbol", "interval", F.unix_micros("timestamp").alias("ts"), *(_r(c).alias(c) for c in KLINE_VALUES), F.col("trades").cast("long").alias("trades"))


def _klines_sql(interval: str = "1h", where: str = "", trades: str = sql.TRADES, source: str = "bars", ctes: str = "") -> str:
    shown = ", ".join(f"{sql.r(c)} AS {c}" for c in KLINE_VALUES)
    return f"WITH {trades},\n{sql.bars(interval=interval)}{ctes}\nSELECT symbol, interval, epoch_us(timestamp) AS ts, {shown}, trades::BIGINT AS trades FROM {source} {where}"


def _finite(*columns: str, digits: int = 6) -> tuple[Query, str]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        held = clean.min_history(adapter.bars(spark, sf_dir))
        return _shown(indicators.finite_features(held), *columns, digits=digits)

    return run, sql.finite_sql(*columns, digits=digits)


def _recursive(*columns: str) -> tuple[Query, str]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        held = clean.min_history(adapter.bars(spark, sf_dir))
        return _shown(features.recursive_features(held), *columns)

    return run, sql.feature_sql(*columns)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.features(adapter.bars(spark, sf_dir))


def _bars_query(interval: str) -> tuple[Query, str]:
    return (lambda spark, d: _klines(adapter.bars(spark, d, interval))), _klines_sql(interval)


def _ladder_sql() -> str:
    each = ",\n".join(sql.bars(f"bars_{i}", i) for i in make.LADDER)
    shown = ", ".join(f"{sql.r(c)} AS {c}" for c in KLINE_VALUES)
    return f"WITH {sql.TRADES},\n{each}\n" + "\nUNION ALL ".join(f"SELECT symbol, interval, epoch_us(timestamp) AS ts, {shown}, trades::BIGINT AS trades FROM bars_{i}" for i in make.LADDER)


def _range_of_change() -> features.Calculator:
    """A calculator such as a user adds: the close's change over ten bars, and an average of the range that halves with each bar."""
    from ..functions.windows import series

    def halving(high, low, close):
        return {"half_range": gone_on(high - low, 0.5, float(high[0] - low[0]))}

    return features.Calculator({"change_10": F.col("close") / F.lag("close", 10).over(series()) - 1, "change_per_atr": F.col("close") - F.col("sma_10")}, halving, ("half_range",))


def _calculated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = features.features(adapter.bars(spark, sf_dir), calculators=(_range_of_change(),))
    return _shown(found, "sma_20", "rsi_14", "change_10", "change_per_atr", "half_range")


CALCULATED_SQL = sql.feature_ctes().replace("WITH RECURSIVE ", "WITH RECURSIVE ") + f""",
own AS (SELECT *, close / lag(close, 10) OVER {sql.WK} - 1 AS change_10, close - sma_10 AS change_per_atr, high - low AS span FROM feats),
half AS (SELECT symbol, interval, i, span AS half_range FROM own WHERE i = 0 UNION ALL SELECT o.symbol, o.interval, o.i, h.half_range / 2 + o.span / 2 FROM half h JOIN own o ON o.symbol = h.symbol AND o.interval = h.interval AND o.i = h.i + 1)
SELECT symbol, interval, epoch_us(timestamp) AS ts, {", ".join(f"{sql.r(c)} AS {c}" for c in ("sma_20", "rsi_14", "change_10", "change_per_atr", "half_range"))} FROM own JOIN half USING (symbol, interval, i)"""


def _newest_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime, timezone

    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    b = adapter.bars(spark, sf_dir)
    open_start, open_end = tables.latest_n(b, 7, end=at(9)), tables.latest_n(b, 9, start=at(28))
    return _klines(tables.latest_n(b, 30, at(5), at(20)).unionByName(open_start).unionByName(open_end))


NEWEST_BETWEEN_SQL = "\nUNION ALL ".join(
    "SELECT * FROM (" + _klines_sql(where=f"WHERE {where} QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) <= {n}") + ")"
    for n, where in ((30, "timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"), (7, "timestamp <= TIMESTAMP '2024-01-09'"), (9, "timestamp >= TIMESTAMP '2024-01-28'"))
)


def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indicators.finite_features(clean.min_history(adapter.supplier_bars(spark, sf_dir)))
    return _shown(found, "sma_20", "volatility_20", "volume_ratio", "stoch_d")


# Deduplication, cleaning, tables


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trades(spark, sf_dir)
    return t.select("symbol", F.lit("1h").alias("interval"), F.date_trunc("hour", "timestamp").alias("timestamp"), F.col("price").alias("close"), F.col("id").alias("seq"))


def _arrivals_sql(pick: str) -> str:
    return f"WITH {sql.TRADES} SELECT symbol, '1h' AS interval, epoch_us(date_trunc('hour', timestamp)) AS ts, {sql.r(f'{pick}(price, id)')} AS close FROM trades GROUP BY 1, 2, 3"


ARRIVED = (0, 400, 800, 1200)  # milliseconds after the full hour


def _arrivals_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals a few tenths of a second apart."""
    late = F.element_at(F.array(*map(F.lit, ARRIVED)), (F.col("seq") % 4 + 1).cast("int"))
    return _arrivals(spark, sf_dir).withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + 1000 * late))


def _arrivals_within_sql(unit: str) -> str:
    at = f"date_trunc('hour', timestamp) + to_milliseconds([{', '.join(map(str, ARRIVED))}][id % 4 + 1])"
    return f"""WITH {sql.TRADES}, a AS (SELECT symbol, id, price, {at} AS t FROM trades)
SELECT symbol, '1h' AS interval, arg_max(epoch_us(t), id) AS ts, {sql.r('arg_max(price, id)')} AS close FROM a GROUP BY symbol, date_trunc('{unit}', t)"""


NAMES = ("1m", "3m", "5m", "15m", "30m", "1h", "2h", "4h", "6h", "8h", "12h", "1d", "3d", "1w", "1M", "other")


def _epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of intervals by name, and epochs there and back, of every trade."""
    t = adapter.trades(spark, sf_dir).withColumn("name", F.element_at(F.array(*map(F.lit, NAMES)), (F.col("id") % len(NAMES) + 1).cast("int")))
    ns = times.epoch_ns("timestamp")
    back, ms = times.from_epoch_ns(ns + 999), times.from_epoch_ms(F.call_function("div", ns, F.lit(1_000_000)))
    return t.select("id", "name", times.interval_ms("name").alias("ms"), ns.alias("ns"), F.unix_micros(back).alias("from_ns"), F.unix_micros(ms).alias("from_ms"))


EPOCHS_SQL = f"""WITH {sql.TRADES}, t AS (SELECT id, timestamp, [{', '.join(f"'{n}'" for n in NAMES)}][id % {len(NAMES)} + 1] AS name FROM trades)
SELECT id, name, CASE WHEN name = '1M' THEN 2592000000 WHEN name = 'other' THEN 60000 ELSE left(name, -1)::BIGINT * CASE right(name, 1) WHEN 'm' THEN 60000 WHEN 'h' THEN 3600000 WHEN 'd' THEN 86400000 ELSE 7 * 86400000 END END::BIGINT AS ms,
       epoch_us(timestamp) * 1000 AS ns, epoch_us(timestamp) AS from_ns, epoch_us(timestamp) // 1000 * 1000 AS from_ms FROM t"""


def _non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = lambda c, k: F.when(F.col("trades") % k == 0, float("nan")).when(F.col("trades") % k == 1, float("inf")).when(F.col("trades") % k == 2, float("-inf")).otherwise(F.col(c))
    b = adapter.bars(spark, sf_dir)
    return _shown(clean.non_finite_to_null(b.withColumns({"open": odd("open", 4), "volume": odd("volume", 5)})), "open", "close", "volume")


NON_FINITE_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, epoch_us(timestamp) AS ts, {sql.r('CASE WHEN trades % 4 > 2 THEN open END')} AS open, {sql.r('close')} AS close, {sql.r('CASE WHEN trades % 5 > 2 THEN volume END')} AS volume FROM bars"


def _slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of some series in a span of time, computed from their whole history, with their version."""
    held = clean.select_series(adapter.bars(spark, sf_dir).unionByName(adapter.bars(spark, sf_dir, "4h")), ["click", "view"], ["1h"])
    at = lambda day: F.to_timestamp(F.lit(f"2024-01-{day} 00:00:00"))
    found = clean.emit_slice(features.features(held, version=7), at(10), at(20))
    return _versioned(found, "close", "sma_50", "ema_50", "obv")


def _versioned(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("symbol", "interval", F.unix_micros("timestamp").alias("ts"), *(_r(c).alias(c) for c in columns), "feature_version")


SLICE_SQL = sql.feature_sql("close", "sma_50", "ema_50", "obv", extra=" WHERE symbol IN ('click', 'view') AND timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'").replace("\nSELECT symbol, interval,", "\nSELECT 7::BIGINT AS feature_version, symbol, interval,")


def _feature_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the incremental job: some series up to a day, then all bars, then nothing new."""
    b, out = adapter.bars(spark, sf_dir), scratch_path(spark, "features")
    for held in (_done(b), b, b):
        backfill_features(held, out)
    return _versioned(stored_features(spark, out), *VALUES)


def _feature_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs of the job that goes on from states, over a growing table: each reads new bars and the lookback alone."""
    b, held, out, states = adapter.bars(spark, sf_dir), *(scratch_path(spark, n) for n in ("klines", "features", "states"))
    cut = lambda day: F.to_timestamp(F.lit(f"2024-01-{day} 05:00:00"))
    for part in (_done(b), b.where(F.col("timestamp") < cut(14)), b.where(F.col("timestamp").between(cut(12), cut(21))), b):
        tables.upsert_table(spark, held, part)
        carry_features(tables.read_table(spark, held), out, states, block=256)
    return _versioned(stored_features(spark, out), *VALUES)


FEATURE_BACKFILL_SQL = sql.feature_sql(*VALUES).replace("\nSELECT symbol, interval,", "\nSELECT 2::BIGINT AS feature_version, symbol, interval,")


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    holes = {c: F.when(F.col("trades") % k != 0, F.col(c)) for c, k in (("open", 2), ("high", 3), ("low", 4), ("close", 2), ("volume", 5))}
    return b.withColumns(holes)


def _gappy_sql() -> str:
    holes = ", ".join(f"CASE WHEN trades % {k} <> 0 THEN {c} END AS {c}" for c, k in (("open", 2), ("high", 3), ("low", 4), ("close", 2), ("volume", 5)))
    fill = lambda c: f"coalesce(last_value({c} IGNORE NULLS) OVER {sql.SO_FAR}, first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol, interval ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    shown = ", ".join(f"{sql.r(fill(c))} AS {c}" for c in ("open", "high", "low", "close"))
    return f"WITH {sql.TRADES}, {sql.bars()}, g AS (SELECT symbol, interval, timestamp, {holes} FROM bars) SELECT symbol, interval, epoch_us(timestamp) AS ts, {shown}, {sql.r('coalesce(volume, 0)')} AS volume FROM g"


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    old, new = b.where(F.hour("timestamp") < 18), b.where(F.hour("timestamp") >= 12).withColumn("close", F.col("close") + 1)
    return _shown(tables.upsert(old, new), "close", "volume")


def _upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, path = adapter.bars(spark, sf_dir), scratch_path(spark, "klines")
    tables.upsert_table(spark, path, b.where(F.hour("timestamp") < 18))
    tables.upsert_table(spark, path, b.where(F.hour("timestamp") >= 12).withColumn("close", F.col("close") + 1))
    return _shown(tables.read_table(spark, path), "close", "volume")


UPSERT_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, epoch_us(timestamp) AS ts, {sql.r('close + CASE WHEN hour(timestamp) >= 12 THEN 1 ELSE 0 END')} AS close, {sql.r('volume')} AS volume FROM bars"


def _between(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime, timezone

    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    return _klines(tables.klines_between(adapter.bars(spark, sf_dir), "click", "1h", at(5), at(9), 60))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indicators.finite_features(clean.min_history(adapter.bars(spark, sf_dir))).select("symbol", "interval", "timestamp", "open", "high", "low", "close", "volume", "sma_20", "volume_ratio", "volatility_20", "obv")
    return _shown(make.downsample_blocks(found, 4), "open", "high", "low", "close", "volume", "sma_20", "volume_ratio", "volatility_20", "obv")


BLOCKS_SQL = f"""WITH {sql.TRADES}, {sql.bars()}, {sql.finite()},
n AS (SELECT *, i // 4 AS block FROM finite)
SELECT symbol, interval, min(epoch_us(timestamp)) AS ts, {sql.r('arg_min(open, timestamp)')} AS open, {sql.r('max(high)')} AS high, {sql.r('min(low)')} AS low, {sql.r('arg_max(close, timestamp)')} AS close, {sql.r('sum(volume)')} AS volume,
       {sql.r('avg(sma_20)')} AS sma_20, {sql.r('sum(volume_ratio)')} AS volume_ratio, {sql.r('avg(volatility_20)')} AS volatility_20, {sql.r('avg(obv)')} AS obv
FROM n GROUP BY symbol, interval, block HAVING count(*) = 4"""


def _lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indicators.lag_features(adapter.bars(spark, sf_dir), ["close", "volume", "unknown"])
    return _shown(found, *(f"{c}_lag_{k}" for c in ("close", "volume") for k in (1, 2, 3, 5, 10)))


LAGS_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, epoch_us(timestamp) AS ts, " + ", ".join(f"{sql.r(f'lag({c}, {k}) OVER {sql.WK}')} AS {c}_lag_{k}" for c in ("close", "volume") for k in (1, 2, 3, 5, 10)) + " FROM bars"
ROLLED = [(c, k, n) for c in ("close", "volume") for n in (5, 10, 20, 50) for k in ("mean", "std", "min", "max")]


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(indicators.rolling_features(adapter.bars(spark, sf_dir), ["close", "volume"]), *(f"{c}_{k}_{n}" for c, k, n in ROLLED))


ROLLING_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, epoch_us(timestamp) AS ts, " + ", ".join(f"{sql.r(sql.strict({'mean': 'avg', 'std': 'stddev_pop'}.get(k, k), c, n))} AS {c}_{k}_{n}" for c, k, n in ROLLED) + " FROM bars"

REALTIME = (*(f"sma_{n}" for n in AVERAGES), *features.REALTIME)


def _latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(features.features_latest(adapter.bars(spark, sf_dir), 300), *VALUES)


LATEST_SQL = sql.feature_ctes().replace(f"\n{sql.finite()}", "\nb300 AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) AS place FROM bars) WHERE place <= 300),\n" + sql.finite("b300")) + "\nSELECT symbol, interval, epoch_us(timestamp) AS ts, " + ", ".join(f"{sql.r(c)} AS {c}" for c in VALUES) + " FROM feats QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) = 1"


# Timeframes


def _timeframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {i: adapter.bars(spark, sf_dir, i).select("symbol", "interval", "timestamp", "close", "volume") for i in ("1h", "4h", "1d")}
    return _multi(timeframes.multi_timeframe(frames))


def _multi(met: DataFrame) -> DataFrame:
    return met.select("symbol", F.unix_micros("timestamp").alias("ts"), *(_r(c).alias(c) for c in ("close", "volume", "close_4h", "volume_4h", "close_1d", "volume_1d")))


TIMEFRAMES_SQL = f"""WITH {sql.TRADES}, {sql.bars()}, {sql.bars('b4', '4h')}, {sql.bars('bd', '1d')}
SELECT b.symbol, epoch_us(b.timestamp) AS ts, {sql.r('b.close')} AS close, {sql.r('b.volume')} AS volume, {sql.r('b4.close')} AS close_4h, {sql.r('b4.volume')} AS volume_4h, {sql.r('bd.close')} AS close_1d, {sql.r('bd.volume')} AS volume_1d
FROM bars b ASOF LEFT JOIN b4 ON b.symbol = b4.symbol AND b.timestamp >= b4.timestamp ASOF LEFT JOIN bd ON b.symbol = bd.symbol AND b.timestamp >= bd.timestamp"""


# Plans and reports


def _range(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = plans.time_range(adapter.bars(spark, sf_dir))
    return t.select("symbol", "interval", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"), "rows")


RANGE_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, min(epoch_us(timestamp)) AS first, max(epoch_us(timestamp)) AS last, count(*) AS rows FROM bars GROUP BY 1, 2"
DONE = "symbol <> 'view' AND (symbol = 'click' OR timestamp < TIMESTAMP '2024-01-15')"


def _done(b: DataFrame) -> DataFrame:
    return b.where(DONE)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    c = plans.coverage(b, _done(b))
    return c.select("symbol", "interval", F.col("klines").cast("long").alias("klines"), F.col("features").cast("long").alias("features"), _r("progress").alias("progress"), "has_features", _r("quality_score").alias("quality_score"))


COVERAGE_SQL = f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, count(*) AS klines, count(*) FILTER (WHERE {DONE}) AS features, {sql.r(f'100.0 * count(*) FILTER (WHERE {DONE}) / count(*)')} AS progress, count(*) FILTER (WHERE {DONE}) > 0 AS has_features, 0.0::DOUBLE AS quality_score FROM bars GROUP BY 1, 2"


def _coverage_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage with the scores of quality reports; a series without features has neither."""
    b = adapter.bars(spark, sf_dir)
    made = settled(features.features(b.where("symbol <> 'view'")))
    c = plans.coverage(b, made, quality.check_quality(made))
    return c.select("symbol", "interval", "klines", "features", _r("progress").alias("progress"), "has_features", _r("quality_score").alias("quality_score"))


def _resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    wanted = b.select("symbol", "interval").distinct().unionByName(spark.createDataFrame([("none", "1h")], "symbol string, interval string"))
    p = plans.resume_plan(b, _done(b), wanted)
    return p.select("symbol", "interval", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"), F.col("rows").cast("long").alias("rows"), "status", F.unix_micros("start").alias("start"))


RESUME_SQL = f"""WITH {sql.TRADES}, {sql.bars()},
p AS (SELECT symbol, interval, min(epoch_us(timestamp)) AS first, max(epoch_us(timestamp)) AS last, count(*) AS rows, max(epoch_us(timestamp)) FILTER (WHERE {DONE}) AS done FROM bars GROUP BY 1, 2
      UNION ALL SELECT 'none', '1h', NULL, NULL, 0, NULL)
SELECT symbol, interval, first, last, rows, CASE WHEN last IS NULL THEN 'no_data' WHEN done IS NULL THEN 'from_start' WHEN done >= last - 5 * 3600000000 THEN 'up_to_date' ELSE 'resume' END AS status,
       CASE WHEN last IS NOT NULL THEN coalesce(done + 3600000000, first) END AS start FROM p"""


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _done(adapter.bars(spark, sf_dir))
    p = plans.backfill_plan(spark, b, ["click", "view", "error"], ["1h", "4h"], F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return p.select("symbol", "interval", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "needed")


BACKFILL_SQL = f"""WITH {sql.TRADES}, {sql.bars()},
w AS (SELECT s.symbol, i.interval FROM (VALUES ('click'), ('view'), ('error')) s(symbol), (VALUES ('1h'), ('4h')) i(interval)),
l AS (SELECT symbol, interval, max(epoch_us(timestamp)) AS last FROM bars WHERE {DONE} GROUP BY 1, 2),
p AS (SELECT w.symbol, w.interval, coalesce(last + 3600000000, epoch_us(TIMESTAMP '2024-02-01') - 365 * 86400000000) AS start, epoch_us(TIMESTAMP '2024-02-01') AS "end" FROM w LEFT JOIN l USING (symbol, interval))
SELECT symbol, interval, start, "end", ("end" - start) / 1000 > 60000 AS needed FROM p"""


def _nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indicators.finite_features(clean.min_history(adapter.bars(spark, sf_dir))).select(*FINITE)
    n = plans.null_report(found)
    return n.select("column", F.col("nulls").cast("long").alias("nulls"), _r("percent").alias("percent"))


NULLS_SQL = f"WITH {sql.TRADES}, {sql.bars()}, {sql.finite()}\n" + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, {sql.r(f'100.0 * (count(*) - count({c})) / count(*)')} AS percent FROM finite" for c in FINITE)


# Quality


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.newest(_features(spark, sf_dir))


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.missing(_sample(spark, sf_dir))
    return m.select("symbol", "interval", F.col("rows").cast("long").alias("rows"), "total_features", "total_missing", _r("missing_percentage").alias("missing_percentage"), F.size("features_with_missing").cast("long").alias("n_with_missing"), F.size("critical_missing_features").cast("long").alias("n_critical"))


def _outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = quality.outliers(_sample(spark, sf_dir))
    return o.select("symbol", "interval", "feature", F.col("present").cast("long").alias("present"), F.col("count").cast("long").alias("count"), _r("percentage").alias("percentage"), _r("max_zscore", 4).alias("max_zscore"))


def _correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = quality.correlation(_sample(spark, sf_dir))
    return c.select("symbol", "interval", F.size("highly_correlated_pairs").cast("long").alias("pairs"), _r("max_correlation").alias("max_correlation"))


def _variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality.low_variance(quality.moments(_sample(spark, sf_dir)))
    return v.select("symbol", "interval", F.size("low_variance_features").cast("long").alias("low"), F.col("zero_variance_count").cast("long").alias("zero_variance_count"))


def _integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity(_sample(spark, sf_dir)).select("symbol", "interval", *(F.col(c).cast("long").alias(c) for c in ("rows", *quality.INTEGRITY)), "is_valid")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = settled(_sample(spark, sf_dir))
    held = quality.moments(sample)
    return quality.feature_scores(held, quality.outliers(sample, held)).select("symbol", "interval", "feature", _r("score").alias("score"))


def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_quality(_features(spark, sf_dir)).select("symbol", "interval", F.col("total_rows").cast("long").alias("total_rows"), _r("overall_quality_score").alias("overall_quality_score"), "low_quality")


QUALITY_CTES = sql.feature_ctes() + ",\n" + sql.FEATURE_LONG + "\n"
SCORES = "greatest(100 - least(200.0 * (rows - present) / rows, 50) - CASE WHEN present > 3 THEN least(5 * coalesce(pct, 0), 30) ELSE 0 END - CASE WHEN variance < 1e-10 THEN 20 ELSE 0 END, 0)"
OVERALL_SQL = QUALITY_CTES + f"""SELECT symbol, interval, it.rows AS total_rows, {sql.r('score')} AS overall_quality_score, score < 70 AS low_quality FROM (
  SELECT symbol, interval, it.rows AS rows, greatest(100 - least(2 * miss, 30) - least(5 * opct, 20) - least(2 * pairs, 20) - least(5 * flat, 20) - CASE WHEN hl + o + h + l + c + v > 0 THEN 10 ELSE 0 END, 0) AS score
  FROM it JOIN ms USING (symbol, interval) JOIN cp USING (symbol, interval) JOIN va USING (symbol, interval) JOIN (SELECT symbol, interval, 100.0 * sum(n) / sum(present) AS opct FROM ou GROUP BY 1, 2) USING (symbol, interval)) it"""


def _recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.check_quality(_features(spark, sf_dir), wanted=adapter.bars(spark, sf_dir).select("symbol", "interval").distinct().unionByName(spark.createDataFrame([("none", "1h")], "symbol string, interval string")))
    return found.select("symbol", "interval", F.array_join("recommendations", "; ").alias("recommendations"), "error", _r("overall_quality_score").alias("overall_quality_score"))


def _correlation_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations over whole histories, from co-moments that tasks make and merge."""
    f = _features(spark, sf_dir).withColumn("period", F.timestamp_micros(F.lit(0).cast("long")))
    names = quality.numeric_columns(f)
    states = quality_state.merged_states(quality_state.partial_states(f.repartition(7)), len(names))
    return quality_state.state_correlation(states, names).select("symbol", "interval", F.size("highly_correlated_pairs").cast("long").alias("pairs"), _r("max_correlation").alias("max_correlation"))


def _varies(text: str) -> str:
    """Correlations only of values that vary by more than rounding."""
    for x in ("a", "b"):
        text = text.replace(f"min({x}.value) < max({x}.value)", f"max({x}.value) - min({x}.value) > 1e-9 * greatest(abs(max({x}.value)), abs(min({x}.value)))")
    return text


QUALITY_WHOLE_SQL = _varies(sql.feature_ctes() + ",\n" + sql.FEATURE_LONG).replace(") WHERE place <= 1000)", "))")

WEEK = 604_800


def _stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly reports of features that come in four parts, none of which ends with a week."""
    held, states, reports, state = (scratch_path(spark, n) for n in ("features", "states", "reports", "state"))
    _fed(spark, _features(spark, sf_dir), "features", lambda f: streams.stream_quality(f, held, states, reports, state, WEEK, None).awaitTermination())
    r = streams.latest_reports(spark.read.parquet(reports))
    return r.select(
        "symbol", "interval", F.unix_micros("period").alias("period"), F.col("total_rows").cast("long").alias("total_rows"), _r("missing_analysis.missing_percentage").alias("missing"), F.col("outlier_analysis.total_outliers").alias("outliers"),
        F.size("correlation_analysis.highly_correlated_pairs").cast("long").alias("pairs"), _r("correlation_analysis.max_correlation").alias("max_correlation"), F.col("variance_analysis.zero_variance_count").alias("flat"),
        F.col("data_integrity.is_valid").alias("valid"), _r("overall_quality_score").alias("score"), "low_quality",
    )


STREAM_QUALITY_SQL = _varies(sql.feature_ctes() + ",\n" + sql.FEATURE_LONG).replace(
    "held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) AS place FROM feats) WHERE place <= 1000)",
    f"held AS (SELECT * REPLACE (symbol || '@' || (epoch_us(timestamp) // {WEEK * 1_000_000}) AS symbol) FROM feats)",
) + f"""
SELECT split_part(symbol, '@', 1) AS symbol, interval, split_part(symbol, '@', 2)::BIGINT * {WEEK * 1_000_000} AS period, rows AS total_rows, {sql.r('miss')} AS missing, outliers::BIGINT AS outliers, coalesce(pairs, 0) AS pairs, {sql.r('coalesce(least(1, cmax), 0)')} AS max_correlation, flat, valid, {sql.r('score')} AS score, score < 70 AS low_quality
FROM (SELECT *, greatest(100 - least(2 * miss, 30) - least(5 * opct, 20) - least(2 * coalesce(pairs, 0), 20) - least(5 * flat, 20) - CASE WHEN valid THEN 0 ELSE 10 END, 0) AS score
      FROM (SELECT symbol, interval, rows, hl + o + h + l + c + v = 0 AS valid FROM it) JOIN (SELECT symbol, interval, miss FROM ms) USING (symbol, interval) LEFT JOIN cp USING (symbol, interval) JOIN va USING (symbol, interval)
      JOIN (SELECT symbol, interval, sum(n) AS outliers, 100.0 * sum(n) / sum(present) AS opct FROM ou GROUP BY 1, 2) USING (symbol, interval))"""


COVERAGE_SCORED_SQL = QUALITY_CTES + f""", scored AS ({OVERALL_SQL[len(QUALITY_CTES):]}),
done AS (SELECT symbol, interval, count(*) AS features FROM feats WHERE symbol <> 'view' GROUP BY 1, 2)
SELECT symbol, interval, klines, coalesce(features, 0) AS features, {sql.r('100.0 * coalesce(features, 0) / klines')} AS progress, features IS NOT NULL AS has_features,
       {sql.r("CASE WHEN symbol <> 'view' THEN coalesce(overall_quality_score, 0) ELSE 0 END")} AS quality_score
FROM (SELECT symbol, interval, count(*) AS klines FROM bars GROUP BY 1, 2) LEFT JOIN done USING (symbol, interval) LEFT JOIN scored USING (symbol, interval)"""


def _few_sql(where: str) -> str:
    place = f"list_position([{', '.join(repr(c) for c in VALUES)}], feature)"
    return f"(SELECT symbol, interval, string_agg(feature, ', ' ORDER BY place) AS names FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY {place}) AS place FROM mo LEFT JOIN ou USING (symbol, interval, feature, present) WHERE {where}) WHERE place <= 3 GROUP BY 1, 2)"


RECOMMENDATIONS_SQL = QUALITY_CTES + f""", told AS (
  SELECT symbol, interval, array_to_string(list_filter([
    'High missing data in features: ' || g.names, 'Significant outliers in: ' || o.names, CASE WHEN pairs > 0 THEN 'Remove highly correlated features (' || pairs || ' pairs found)' END,
    CASE WHEN flat > 0 THEN 'Remove ' || flat || ' zero-variance features' END, CASE WHEN bad THEN 'Fix data integrity issues' END, CASE WHEN score < 70 THEN 'Overall quality needs improvement' END], lambda x: x IS NOT NULL)[1:5], '; ') AS recommendations, score
  FROM (SELECT symbol, interval, pairs, flat, hl + o + h + l + c + v > 0 AS bad, greatest(100 - least(2 * miss, 30) - least(5 * opct, 20) - least(2 * pairs, 20) - least(5 * flat, 20) - CASE WHEN hl + o + h + l + c + v > 0 THEN 10 ELSE 0 END, 0) AS score
        FROM it JOIN ms USING (symbol, interval) JOIN cp USING (symbol, interval) JOIN va USING (symbol, interval) JOIN (SELECT symbol, interval, 100.0 * sum(n) / sum(present) AS opct FROM ou GROUP BY 1, 2) USING (symbol, interval))
  LEFT JOIN {_few_sql('100.0 * (rows - present) / rows > 5')} g USING (symbol, interval) LEFT JOIN {_few_sql('pct > 1')} o USING (symbol, interval)),
wanted AS (SELECT DISTINCT symbol, interval FROM bars UNION ALL SELECT 'none', '1h')
SELECT symbol, interval, recommendations, CASE WHEN score IS NULL THEN 'Empty dataframe' END AS error, {sql.r('coalesce(score, 0)')} AS overall_quality_score FROM wanted LEFT JOIN told USING (symbol, interval)"""


# Messages


def _rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    ms = F.unix_millis("timestamp").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), text(c), F.lit('"'))
    row = F.concat(F.lit("["), F.concat_ws(",", ms, *map(quoted, ("open", "high", "low", "close", "volume")), ms, quoted("quote_volume"), text("trades"), quoted("taker_buy_volume"), quoted("taker_buy_quote_volume"), F.lit('"0"')), F.lit("]"))
    payload = b.withColumn("row", row).groupBy("symbol", "interval", F.to_date("timestamp")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("row")), F.lit("]")).alias("value"))
    return _klines(messages.parse_rest_klines(payload))


def _ws_messages(b: DataFrame) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    pairs = {"t": F.unix_millis("timestamp"), "o": text("open"), "h": text("high"), "l": text("low"), "c": text("close"), "v": text("volume"), "T": F.unix_millis("timestamp"), "q": text("quote_volume"), "n": F.col("trades"), "V": text("taker_buy_volume"), "Q": text("taker_buy_quote_volume"), "x": F.col("trades") % 7 != 0}
    written = [F.concat(F.lit(f'"{k}":'), v.cast("string") if k in "tTnx" else F.concat(F.lit('"'), v, F.lit('"'))) for k, v in pairs.items()]
    value = F.concat(F.lit('{"k":{'), F.concat_ws(",", *written), F.lit("}}"))
    broken = F.when(F.col("trades") % 11 == 0, '{"e":"other"}').when(F.col("trades") % 13 == 0, "not json").otherwise(value)
    return b.select(F.concat(F.lower("symbol"), F.lit("@kline_"), "interval").alias("stream"), broken.alias("value"))


def _ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _klines(clean.closed_only(messages.parse_ws_klines(_ws_messages(adapter.bars(spark, sf_dir)))))


WS_SQL = _klines_sql(where="WHERE trades % 11 <> 0 AND trades % 13 <> 0 AND trades % 7 <> 0").replace("SELECT symbol, interval, epoch_us", "SELECT upper(symbol) AS symbol, interval, epoch_us")


def _trades_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trades(spark, sf_dir)
    sent = t.select("symbol", "id", F.to_json(F.struct(F.unix_millis("timestamp").alias("T"), F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"), F.col("is_buyer_maker").alias("m"))).alias("value"))
    got = messages.parse_trades(sent)
    return got.select("symbol", F.unix_millis("timestamp").alias("ms"), "id", _r("price").alias("price"), _r("quantity").alias("quantity"), "is_buyer_maker")


def _book(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trades(spark, sf_dir)
    side = lambda step, gone: F.when(F.col("id") % gone != 0, F.array(F.array((F.col("quantity") + step).cast("string"), F.lit("1")), F.array(F.lit("1"), F.lit("2")))).otherwise(F.array().cast("array<array<string>>"))
    b = messages.top_of_book(t.select("symbol", "id", side(0, 5).alias("bids"), side(1, 7).alias("asks")))
    return b.select("symbol", "id", *(_r(c).alias(c) for c in ("best_bid", "best_ask", "spread", "mid_price")))


BOOK_SQL = f"""WITH {sql.TRADES}, b AS (SELECT symbol, id, CASE WHEN id % 5 <> 0 THEN quantity END AS best_bid, CASE WHEN id % 7 <> 0 THEN quantity + 1 END AS best_ask FROM trades)
SELECT symbol, id, {sql.r('best_bid')} AS best_bid, {sql.r('best_ask')} AS best_ask, {sql.r('CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN best_ask - best_bid END')} AS spread, {sql.r('CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN (best_bid + best_ask) / 2 END')} AS mid_price FROM b"""


def _bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _klines(messages.message_to_kline(messages.kline_to_message(adapter.bars(spark, sf_dir))))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir).select("symbol", F.when(F.col("trades") % 3 != 0, F.col("volume")).alias("volume"), "trades", "interval", "is_closed", "timestamp")
    return messages.to_line_protocol(b, "klines_1h")


LINES_SQL = f"""WITH {sql.TRADES}, {sql.bars()} SELECT 'klines_1h,symbol=' || symbol || ' ' || CASE WHEN trades % 3 <> 0 THEN 'volume=' || volume::DOUBLE::VARCHAR || ',' ELSE '' END || 'trades=' || trades || 'i,interval="' || interval || '",is_closed=T ' || (epoch_us(timestamp) * 1000)::VARCHAR AS value FROM bars"""


def _report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as they are stored under their keys, read back from JSON."""
    text = messages.quality_to_json(quality.check_quality(_features(spark, sf_dir)))
    of = lambda path, kind: F.get_json_object("value", path).cast(kind)
    return text.select("key", of("$.total_rows", "long").alias("total_rows"), _r(of("$.overall_quality_score", "double")).alias("overall_quality_score"), of("$.variance_analysis.zero_variance_count", "long").alias("flat"), of("$.data_integrity.is_valid", "boolean").alias("valid"), of("$.recommendations[0]", "string").alias("advice"))


def _report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.quality_to_json(quality.check_quality(_features(spark, sf_dir)))


def _lines_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that the sink has committed, read back."""
    path = scratch_path(spark, "lines")
    wire.write_lines(_lines(spark, sf_dir), path)
    return wire.read_lines(spark, path).select("value")


REPORT_FIELDS_SQL = RECOMMENDATIONS_SQL[: RECOMMENDATIONS_SQL.rindex("wanted AS")].rstrip().rstrip(",") + f"""
SELECT 'quality:' || symbol || ':' || interval AS key, it.rows AS total_rows, {sql.r("score")} AS overall_quality_score, flat, hl + o + h + l + c + v = 0 AS valid, nullif(split_part(recommendations, '; ', 1), '') AS advice
FROM told JOIN it USING (symbol, interval) JOIN va USING (symbol, interval)"""


# Streams, each run to its end over the given tables


def _fed(spark: SparkSession, df: DataFrame, name: str, land: Callable[[DataFrame], None], order: Column | None = None, parts: int = 4) -> None:
    """land(stream) after each part of df has been written, parts in order (of time, where none is given): its checkpoint makes one stream of them."""
    path, order = scratch_path(spark, name), F.unix_micros("timestamp") if order is None else order
    df = settled(df)
    cuts = df.agg(F.percentile_approx(order, [k / parts for k in range(1, parts)], 1000).alias("c")).first()["c"] or []
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = df if lo is None else df.where(order > lo)
        (part if hi is None else part.where(order <= hi)).write.mode("append").parquet(path)
        land(spark.readStream.schema(df.schema).parquet(path))


def _landed(spark: SparkSession, df: DataFrame, name: str, job: Callable[[DataFrame], DataFrame], order: Column | None = None) -> DataFrame:
    """All rows that job emits for the stream of df."""
    out, state = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")

    def land(source: DataFrame) -> None:
        job(source).writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()

    _fed(spark, df, name, land, order)
    return spark.read.parquet(out)


def _stream_bars(interval: str) -> Query:
    """All bars that the stream emits: those whose end the newest trade has passed by the lateness."""
    return lambda spark, sf_dir: _klines(_landed(spark, adapter.trades(spark, sf_dir), "trades", lambda t: streams.stream_bars(t, interval, "1 hour")))


def _stream_bars_sql(interval: str) -> str:
    return _klines_sql(interval, where=f"WHERE epoch_us(timestamp) + {sql.BAR_MS[interval] * 1000} <= (SELECT max(epoch_us(timestamp)) FROM trades) - 3600000000")


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = adapter.bars(spark, sf_dir)
    return b.unionByName(b.where(F.hour("timestamp") == 3))


def _stream_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _klines(_landed(spark, _repeated(spark, sf_dir), "klines", streams.monotonic_bars))


def _stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some bars come an hour and a half late, behind later ones, whatever part of the stream they fall into."""
    b = adapter.bars(spark, sf_dir).withColumn("seq", F.unix_micros("timestamp") + F.when(F.col("trades") % 5 == 0, 5_400_000_000).otherwise(0))
    return _klines(_landed(spark, b, "arrivals", lambda k: streams.monotonic_bars(k, "seq"), F.col("seq")))


ARRIVALS_SQL = _klines_sql(source="seen", where="WHERE newest IS NULL OR timestamp > newest", ctes=""",
seen AS (SELECT *, max(timestamp) OVER (PARTITION BY symbol, interval ORDER BY epoch_us(timestamp) + CASE WHEN trades % 5 = 0 THEN 5400000000 ELSE 0 END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM bars)""")


def _stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _klines(_landed(spark, _repeated(spark, sf_dir), "repeated", streams.deduplicated))


def _stream_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _ws_messages(adapter.bars(spark, sf_dir))
    return _klines(_landed(spark, sent, "messages", streams.stream_klines, F.xxhash64("stream")))


def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, state = scratch_path(spark, "upserted"), scratch_path(spark, "state")
    _fed(spark, _repeated(spark, sf_dir), "klines", lambda k: streams.upsert_sink(k, path, state, every=None).awaitTermination())
    return _klines(spark.read.parquet(path))


def _stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar's features as the stream emits them, over bars that come in four parts."""
    out, held, state = (scratch_path(spark, n) for n in ("live", "held", "state"))
    _fed(spark, adapter.bars(spark, sf_dir), "klines", lambda k: streams.stream_features(k, held, out, state, LIVE_LOOKBACK, None).awaitTermination())
    return _shown(spark.read.parquet(out), *VALUES)


LIVE_LOOKBACK = 300
#: A series of its own for each bar: the bar and those before it that its ring holds.
LIVE_SQL = sql.feature_ctes().replace(f"\n{sql.finite()}", f"""
placed AS (SELECT *, row_number() OVER {sql.WK} AS place FROM bars),
ring AS (SELECT b.* EXCLUDE (symbol, place), n.symbol || '@' || n.place AS symbol FROM placed n JOIN placed b ON b.symbol = n.symbol AND b.interval = n.interval AND b.place BETWEEN n.place - {LIVE_LOOKBACK - 1} AND n.place),
{sql.finite("ring")}""") + "\nSELECT split_part(symbol, '@', 1) AS symbol, interval, epoch_us(timestamp) AS ts, " + ", ".join(f"{sql.r(c)} AS {c}" for c in VALUES) + " FROM feats QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) = 1"


def _stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with gaps, some of them late or twice, filled by what came before in their series."""
    b = _gappy(spark, sf_dir)
    with streams.keyed_state(spark):
        cleaned = _landed(spark, b.unionByName(b.where(F.hour("timestamp") == 3)), "gappy", streams.stream_clean)
    return _shown(cleaned, "open", "high", "low", "close", "volume")


def _stream_clean_sql() -> str:
    text = _gappy_sql()
    for c in ("open", "high", "low", "close"):
        text = text.replace(f", first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol, interval ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)", "")
    return text


MISSING_SQL = QUALITY_CTES + f"""SELECT symbol, interval, rows, 58::BIGINT AS total_features, total_missing::BIGINT AS total_missing, {sql.r('miss')} AS missing_percentage, nw AS n_with_missing, nc AS n_critical
FROM ms JOIN (SELECT symbol, interval, count(*) FILTER (WHERE present < rows) AS nw, count(*) FILTER (WHERE 100.0 * (rows - present) / rows > 5) AS nc FROM mo GROUP BY 1, 2) USING (symbol, interval)"""

ENTRIES: dict[str, tuple[Query, str | None]] = {
    "bars_1h": _bars_query("1h"),
    "bars_15m": _bars_query("15m"),
    "bars_all_intervals": ((lambda s, d: _klines(make.bars_of_all_intervals(adapter.trades(s, d)))), _ladder_sql()),
    "features_calculators": (_calculated, CALCULATED_SQL),
    "latest_n_between": (_newest_between, NEWEST_BETWEEN_SQL),
    "resample_4h": ((lambda s, d: _klines(make.resample_bars(adapter.bars(s, d, "15m"), "4h"))), _klines_sql("4h")),
    "downsample_blocks": (_blocks, BLOCKS_SQL),
    "supplier_features": (_supplier, sql.finite_sql("sma_20", "volatility_20", "volume_ratio", "stoch_d", interval="1d", trades=sql.SUPPLIER_TRADES)),
    "klines_between": (_between, _klines_sql(where="WHERE symbol = 'click' AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-09' ORDER BY timestamp LIMIT 60")),
    "latest_n": ((lambda s, d: _klines(tables.latest_n(adapter.bars(s, d), 50))), _klines_sql(where="QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) <= 50")),
    "latest_rows": ((lambda s, d: _klines(tables.latest_rows(adapter.bars(s, d)))), _klines_sql(where="QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) = 1")),
    "dedupe_first": ((lambda s, d: _shown(clean.dedupe_first(_arrivals(s, d), "seq"), "close")), _arrivals_sql("arg_min")),
    "dedupe_last": ((lambda s, d: _shown(clean.dedupe_last(_arrivals(s, d), "seq", True), "close")), _arrivals_sql("arg_max")),
    "dedupe_last_second": ((lambda s, d: _shown(clean.dedupe_last(_arrivals_within(s, d), "seq", True), "close")), _arrivals_within_sql("second")),
    "dedupe_last_time": ((lambda s, d: _shown(clean.dedupe_last(_arrivals_within(s, d), "seq"), "close")), _arrivals_within_sql("microseconds")),
    "interval_epochs": (_epochs, EPOCHS_SQL),
    "non_finite_to_null": (_non_finite, NON_FINITE_SQL),
    "feature_slice": (_slice, SLICE_SQL),
    "feature_backfill": (_feature_backfill, FEATURE_BACKFILL_SQL),
    "feature_carried": (_feature_carried, FEATURE_BACKFILL_SQL),
    "upsert": (_upsert, UPSERT_SQL),
    "upsert_table": (_upsert_table, UPSERT_SQL),
    "clean_ohlcv": ((lambda s, d: _shown(clean.clean_ohlcv(_gappy(s, d)), "open", "high", "low", "close", "volume")), _gappy_sql()),
    "sma": _finite(*(f"sma_{n}" for n in AVERAGES)),
    "bollinger": _finite("bb_upper", "bb_middle", "bb_lower", "bb_width", "bb_percent"),
    "cci": _finite("cci_20"),
    "stochastic": _finite("stoch_k", "stoch_d"),
    "williams_r": _finite("williams_r"),
    "mfi": _finite("mfi_14"),
    "obv_vwap": _finite("obv", "vwap"),
    "volatility": _finite("volatility_20", "volatility_50"),
    "realized_volatility": _finite("realized_volatility"),
    "price_position_trend": _finite("price_position", "trend_strength"),
    "volume_features": _finite("volume_ratio", "volume_momentum"),
    "order_flow": _finite("buy_pressure", "order_flow_imbalance"),
    "sharpe": _finite("sharpe_ratio_20"),
    "spread": _finite("spread_ratio", "avg_spread", "spread_volatility", "effective_spread"),
    "kyle_amihud_impact": _finite("kyle_lambda", "amihud_illiquidity", "price_impact", digits=8),
    "turnover": _finite("volume_turnover"),
    "lag_features": (_lags, LAGS_SQL),
    "rolling_features": (_rolling, ROLLING_SQL),
    "ema": _recursive(*(f"ema_{n}" for n in AVERAGES)),
    "macd": _recursive("macd", "macd_signal", "macd_hist"),
    "momentum_score": _recursive("momentum_score"),
    "rsi": _recursive("rsi_14", "rsi_21"),
    "atr": _recursive("atr_14", "atr_21"),
    "adx_di": _recursive("plus_di", "minus_di", "adx_14"),
    "realtime_features": ((lambda s, d: _shown(features.realtime_features(adapter.bars(s, d)), *REALTIME)), sql.feature_sql(*REALTIME)),
    "features_blocked": ((lambda s, d: _shown(features.features_blocked(adapter.bars(s, d)), *VALUES)), sql.feature_sql(*VALUES)),
    "features_full": ((lambda s, d: _shown(_features(s, d), *VALUES)), sql.feature_sql(*VALUES)),
    "features_latest": (_latest_features, LATEST_SQL),
    "multi_timeframe": (_timeframes, TIMEFRAMES_SQL),
    "time_range": (_range, RANGE_SQL),
    "row_counts": ((lambda s, d: plans.row_counts(adapter.bars(s, d))), f"WITH {sql.TRADES}, {sql.bars()} SELECT symbol, interval, count(*) AS rows FROM bars GROUP BY 1, 2"),
    "coverage": (_coverage, COVERAGE_SQL),
    "coverage_scored": (_coverage_scored, COVERAGE_SCORED_SQL),
    "resume_plan": (_resume, RESUME_SQL),
    "backfill_plan": (_backfill, BACKFILL_SQL),
    "null_report": (_nulls, NULLS_SQL),
    "quality_missing": (_missing, MISSING_SQL),
    "quality_outliers": (_outliers, QUALITY_CTES + f"SELECT symbol, interval, feature, present, n AS count, {sql.r('pct')} AS percentage, {sql.r('zmax', 4)} AS max_zscore FROM ou"),
    "quality_correlation": (_correlation, QUALITY_CTES + f"SELECT symbol, interval, pairs, {sql.r('least(1, cmax)')} AS max_correlation FROM cp"),
    "quality_variance": (_variance, QUALITY_CTES + "SELECT symbol, interval, low, flat AS zero_variance_count FROM va"),
    "quality_integrity": (_integrity, QUALITY_CTES + "SELECT symbol, interval, rows, hl AS high_less_than_low, o AS negative_open, h AS negative_high, l AS negative_low, c AS negative_close, v AS negative_volume, hl + o + h + l + c + v = 0 AS is_valid FROM it"),
    "quality_feature_scores": (_scores, QUALITY_CTES + f"SELECT symbol, interval, feature, {sql.r(SCORES)} AS score FROM mo LEFT JOIN ou USING (symbol, interval, feature, present)"),
    "quality_overall": (_overall, OVERALL_SQL),
    "quality_recommendations": (_recommendations, RECOMMENDATIONS_SQL),
    "quality_json": (_report_json, None),
    "quality_json_fields": (_report_fields, REPORT_FIELDS_SQL),
    "quality_correlation_whole": (_correlation_whole, QUALITY_WHOLE_SQL + f"\nSELECT symbol, interval, pairs, {sql.r('least(1, cmax)')} AS max_correlation FROM cp"),
    "stream_quality": (_stream_quality, STREAM_QUALITY_SQL),
    "parse_rest_klines": (_rest, _klines_sql()),
    "parse_ws_klines": (_ws, WS_SQL),
    "parse_trades": (_trades_parsed, f"WITH {sql.TRADES} SELECT symbol, epoch_us(timestamp) // 1000 AS ms, id, {sql.r('price')} AS price, {sql.r('quantity')} AS quantity, maker AS is_buyer_maker FROM trades"),
    "top_of_book": (_book, BOOK_SQL),
    "bus_messages": (_bus, _klines_sql()),
    "line_protocol": (_lines, LINES_SQL),
    "line_protocol_committed": (_lines_committed, LINES_SQL),
    "stream_klines": (_stream_klines, WS_SQL),
    "stream_monotonic": (_stream_monotonic, _klines_sql()),
    "stream_upsert": (_stream_upsert, _klines_sql()),
    "stream_arrivals": (_stream_arrivals, ARRIVALS_SQL),
    "stream_deduplicated": (_stream_deduplicated, _klines_sql()),
    "stream_bars": (_stream_bars("4h"), _stream_bars_sql("4h")),
    "stream_bars_closed": (_stream_bars("1d"), _stream_bars_sql("1d")),
    "stream_features": (_stream_features, LIVE_SQL),
    "stream_clean": (_stream_clean, _stream_clean_sql()),
}


def _utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with adapter.in_utc(spark):
            return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _utc(query) for name, (query, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in ENTRIES.items() if text}
