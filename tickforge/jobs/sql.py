"""The queries' SQL: independent definitions over the given tables, for comparison."""

from __future__ import annotations

import math

from ..schema import AVERAGES, FINITE, RECURSIVE, VALUES

BAR_MS = {name: minutes * 60_000 for name, minutes in {"1m": 1, "3m": 3, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "4h": 240, "6h": 360, "8h": 480, "12h": 720, "1d": 1440}.items()}

TRADES = """trades AS (
  SELECT event_type AS symbol, ts AS timestamp, event_id AS id, value AS price, json_extract_string(props, '$.k')::DOUBLE AS quantity, user_id % 2 <> 0 AS maker
  FROM events)"""
SUPPLIER_TRADES = """trades AS (
  SELECT l_suppkey::VARCHAR AS symbol, l_shipdate AS timestamp, l_orderkey * 10 + l_linenumber AS id, l_extendedprice / l_quantity AS price, l_quantity AS quantity, l_linenumber % 2 <> 0 AS maker
  FROM lineitem)"""


def bars(name: str = "bars", interval: str = "1h") -> str:
    size = BAR_MS[interval] * 1000
    return f"""{name} AS (
  SELECT symbol, '{interval}' AS interval, make_timestamp((epoch_us(timestamp) // {size}) * {size}) AS timestamp,
         arg_min(price, (timestamp, id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (timestamp, id)) AS close,
         sum(quantity) AS volume, sum(price * quantity) AS quote_volume, count(*) AS trades,
         sum(CASE WHEN maker THEN 0 ELSE quantity END) AS taker_buy_volume, sum(CASE WHEN maker THEN 0 ELSE price * quantity END) AS taker_buy_quote_volume
  FROM trades GROUP BY 1, 2, 3)"""


def r(x: str, digits: int = 6) -> str:
    return f"round(({x})::DOUBLE, {digits}) + 0.0"


def rows(n: int) -> str:
    return f"(PARTITION BY symbol, interval ORDER BY timestamp ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def strict(agg: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {rows(n)} = {n} THEN {agg}({x}) OVER {rows(n)} END"


WK = "(PARTITION BY symbol, interval ORDER BY timestamp)"
SO_FAR = "(PARTITION BY symbol, interval ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
YEAR = repr(math.sqrt(252))


def finite(source: str = "bars") -> str:
    """CTEs that end in `finite`: the source's columns and the finite indicators."""
    averages = ", ".join(f"{strict('avg', 'close', n)} AS sma_{n}" for n in AVERAGES)
    return f"""s1 AS (
  SELECT *, row_number() OVER {WK} - 1 AS i, count(*) OVER (PARTITION BY symbol, interval) AS k, lag(close) OVER {WK} AS c1, (high + low + close) / 3 AS tp FROM {source}),
s2 AS (
  SELECT *, CASE WHEN c1 > 0 THEN close / c1 - 1 END AS ret, close - c1 AS dc, tp - lag(tp) OVER {WK} AS dtp, high - low AS hl,
         CASE WHEN volume > 0 THEN taker_buy_volume / volume END AS bp,
         CASE WHEN high > 0 AND low > 0 THEN sqrt(pow(ln(high / low), 2) / (4 * ln(2))) END AS rv,
         CASE WHEN volume > 0 THEN abs(coalesce(close - c1, 0)) / sqrt(volume) END AS ky,
         {strict('avg', 'tp', 20)} AS tp20, list(tp) OVER {rows(20)} AS tps, {strict('avg', 'volume', 20)} AS v20,
         {strict('min', 'low', 14)} AS l14, {strict('max', 'high', 14)} AS h14, {strict('min', 'low', 20)} AS l20, {strict('max', 'high', 20)} AS h20,
         {strict('stddev_pop', 'close', 20)} AS sd, {averages}
  FROM s1 WHERE k >= 20),
s3 AS (
  SELECT *, CASE WHEN close * volume > 0 THEN abs(ret) / (close * volume) END AS am,
         CASE WHEN h14 > l14 THEN 100 * (close - l14) / (h14 - l14) WHEN h14 IS NOT NULL THEN 0 END AS fast,
         list_avg(list_transform(tps, lambda x: abs(x - tp20))) AS off,
         sum(CASE WHEN dtp > 0 THEN tp * volume ELSE 0 END) OVER {rows(14)} AS pos, sum(CASE WHEN dtp < 0 THEN tp * volume ELSE 0 END) OVER {rows(14)} AS neg,
         count(dtp) OVER {rows(14)} AS nmf, {strict('avg', 'ret', 20)} AS ret20, {strict('stddev_pop', 'ret', 20)} AS rsd20
  FROM s2),
s4 AS (SELECT *, {strict('avg', 'fast', 3)} AS slow FROM s3),
finite0 AS (
  SELECT *, {strict('avg', 'slow', 3)} AS stoch_d,
    CASE WHEN k > 20 THEN sma_20 END AS bb_middle, CASE WHEN k > 20 THEN sma_20 + 2 * sd END AS bb_upper, CASE WHEN k > 20 THEN sma_20 - 2 * sd END AS bb_lower, CASE WHEN k > 20 THEN 4 * sd END AS bb_width,
    CASE WHEN k > 20 THEN CASE WHEN 4 * sd > 0 THEN (close - (sma_20 - 2 * sd)) / (4 * sd) ELSE 0.5 END END AS bb_percent,
    CASE WHEN k > 20 AND tp20 IS NOT NULL THEN CASE WHEN off > 0 THEN (tp - tp20) / (0.015 * off) ELSE 0 END END AS cci_20,
    CASE WHEN h14 > l14 THEN -100 * (h14 - close) / (h14 - l14) WHEN h14 IS NOT NULL THEN 0 END AS williams_r,
    CASE WHEN nmf = 14 THEN CASE WHEN pos + neg < 1 THEN 0 ELSE 100 * pos / (pos + neg) END END AS mfi_14,
    sum(CASE WHEN i = 0 THEN volume ELSE sign(dc) * volume END) OVER {SO_FAR} AS obv,
    CASE WHEN sum(volume) OVER {SO_FAR} > 0 THEN sum(tp * volume) OVER {SO_FAR} / sum(volume) OVER {SO_FAR} END AS vwap,
    CASE WHEN v20 > 0 THEN volume / v20 END AS volume_ratio,
    {strict('stddev_pop', 'ret', 20)} * {YEAR} AS volatility_20, {strict('stddev_pop', 'ret', 50)} * {YEAR} AS volatility_50, {strict('avg', 'rv', 20)} * {YEAR} AS realized_volatility,
    CASE WHEN h20 > l20 THEN (close - l20) / (h20 - l20) ELSE 0.5 END AS price_position,
    CASE WHEN sma_50 > 0 THEN (close - sma_50) / sma_50 END AS trend_strength,
    CASE WHEN v20 > 0 THEN ({strict('avg', 'volume', 5)}) / v20 END AS volume_momentum,
    bp AS buy_pressure, {strict('avg', 'bp', 20)} - 0.5 AS order_flow_imbalance,
    CASE WHEN rsd20 > 0 THEN ret20 / rsd20 ELSE 0 END AS sharpe_ratio_20,
    CASE WHEN close > 0 THEN hl / close END AS spread_ratio, {strict('avg', 'hl', 20)} AS avg_spread, {strict('stddev_pop', 'hl', 20)} AS spread_volatility,
    {strict('avg', 'ky', 20)} AS kyle_lambda, {strict('avg', 'am', 20)} AS amihud_illiquidity,
    CASE WHEN v20 > 0 AND volume > 0 THEN abs(ret) / (volume / v20) END AS price_impact,
    CASE WHEN ({strict('sum', 'volume', 100)}) > 0 THEN ({strict('sum', 'volume', 20)}) / ({strict('sum', 'volume', 100)}) END AS volume_turnover,
    2 * abs(close - (high + low) / 2) AS effective_spread
  FROM s4),
finite AS (SELECT *, CASE WHEN stoch_d IS NOT NULL THEN slow END AS stoch_k FROM finite0)"""


def _step(name: str, first: int, seed: str, alpha: str, x: str) -> str:
    return f"CASE WHEN s.i < {first} THEN NULL WHEN s.i = {first} THEN {seed} ELSE q.{name} + ({alpha}) * ({x} - q.{name}) END AS {name}"


def recursive(source: str = "finite") -> str:
    """CTEs (to stand after WITH RECURSIVE) that end in `feats`: the source's columns and the recursive indicators."""
    seeds = ", ".join(f"avg({x}) OVER {rows(n)} AS {x}_{n}" for x, ns in (("close", (*AVERAGES, 12, 26)), ("gain", (14, 21)), ("loss", (14, 21)), ("tr", (14, 21))) for n in ns)
    sums = ", ".join(f"sum({x}) OVER {rows(13)} AS {x}_13" for x in ("tr", "pdm", "mdm"))
    steps = [_step(f"ema_{n}", n - 1, f"s.close_{n}", f"2.0 / {n + 1}", "s.close") for n in AVERAGES]
    steps += [_step("e12", 11, "s.close_12", "2.0 / 13", "s.close"), _step("e26", 25, "s.close_26", "2.0 / 27", "s.close"), _step("m12", 25, "s.close_12", "2.0 / 13", "s.close")]
    for n in (14, 21):
        steps += [_step(f"g{n}", n, f"s.gain_{n}", f"1.0 / {n}", "s.gain"), _step(f"l{n}", n, f"s.loss_{n}", f"1.0 / {n}", "s.loss"), _step(f"atr_{n}", n, f"s.tr_{n}", f"1.0 / {n}", "s.tr")]
    steps += [f"CASE WHEN s.i < 13 THEN NULL WHEN s.i = 13 THEN s.{x}_13 ELSE q.w_{x} - q.w_{x} / 14 + s.{x} END AS w_{x}" for x in ("tr", "pdm", "mdm")]
    held = [f"ema_{n}" for n in AVERAGES] + ["e12", "e26", "m12", "g14", "l14", "atr_14", "g21", "l21", "atr_21", "w_tr", "w_pdm", "w_mdm"]
    names = [*held, "line", "plus_di", "minus_di", "dx", "msum", "macd_signal", "dsum", "adx_14"]
    blank = ", ".join(f"NULL::DOUBLE AS {n}" for n in names)
    return f"""p1 AS (
  SELECT *, lag(high) OVER {WK} AS ph, lag(low) OVER {WK} AS pl FROM {source}),
p2 AS (
  SELECT *, CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0) END AS gain, CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0) END AS loss,
         CASE WHEN c1 IS NOT NULL THEN greatest(high - low, abs(high - c1), abs(low - c1)) END AS tr,
         CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph WHEN ph IS NOT NULL THEN 0 END AS pdm, CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low WHEN ph IS NOT NULL THEN 0 END AS mdm
  FROM p1),
s AS MATERIALIZED (SELECT symbol, interval, i, close, gain, loss, tr, pdm, mdm, {seeds}, {sums} FROM p2),
q AS (
  SELECT symbol, interval, i, {blank} FROM s WHERE i = 0
  UNION ALL
  SELECT symbol, interval, i, {', '.join(held)}, line, plus_di, minus_di, dx, msum,
         CASE WHEN i < 33 THEN NULL WHEN i = 33 THEN msum / 9 ELSE psignal + 0.2 * (line - psignal) END,
         dsum, CASE WHEN i < 27 THEN NULL WHEN i = 27 THEN dsum / 14 ELSE (padx * 13 + dx) / 14 END
  FROM (
    SELECT *, CASE WHEN i < 25 THEN NULL WHEN i = 25 THEN line WHEN i <= 33 THEN pmsum + line END AS msum,
           CASE WHEN i < 14 THEN NULL WHEN i = 14 THEN dx WHEN i <= 27 THEN pdsum + dx END AS dsum
    FROM (
      SELECT *, CASE WHEN plus_di + minus_di = 0 THEN 0 ELSE 100 * abs(plus_di - minus_di) / (plus_di + minus_di) END AS dx
      FROM (
        SELECT *, m12 - e26 AS line, CASE WHEN i < 14 THEN NULL WHEN w_tr = 0 THEN 0 ELSE 100 * w_pdm / w_tr END AS plus_di, CASE WHEN i < 14 THEN NULL WHEN w_tr = 0 THEN 0 ELSE 100 * w_mdm / w_tr END AS minus_di
        FROM (SELECT s.symbol, s.interval, s.i, {', '.join(steps)}, q.msum AS pmsum, q.macd_signal AS psignal, q.dsum AS pdsum, q.adx_14 AS padx FROM q JOIN s ON s.symbol = q.symbol AND s.interval = q.interval AND s.i = q.i + 1))))),
rec AS (
  SELECT symbol, interval, i, {', '.join(f'ema_{n}' for n in AVERAGES)}, CASE WHEN macd_signal IS NOT NULL THEN line END AS macd, macd_signal, line - macd_signal AS macd_hist,
         CASE WHEN e26 > 0 THEN (e12 - e26) / e26 END AS momentum_score,
         CASE WHEN g14 + l14 = 0 THEN 0 ELSE 100 * g14 / (g14 + l14) END AS rsi_14, CASE WHEN g21 + l21 = 0 THEN 0 ELSE 100 * g21 / (g21 + l21) END AS rsi_21,
         atr_14, atr_21, plus_di, minus_di, adx_14 FROM q),
feats AS (SELECT f.*, {', '.join(f'rec.{c}' for c in RECURSIVE)} FROM {source} f JOIN rec USING (symbol, interval, i))"""


def picked(columns: tuple[str, ...], ctes: str, source: str, interval: str = "1h", trades: str = TRADES, digits: int = 6, extra: str = "") -> str:
    recursive_ = "RECURSIVE " if source == "feats" else ""
    shown = ", ".join(f"{r(c, digits)} AS {c}" for c in columns)
    return f"WITH {recursive_}{trades},\n{bars(interval=interval)},\n{ctes}\nSELECT symbol, interval, epoch_us(timestamp) AS ts, {shown} FROM {source}{extra}"


def finite_sql(*columns: str, **how) -> str:
    return picked(columns, finite(), "finite", **how)


def feature_sql(*columns: str, **how) -> str:
    return picked(columns, finite() + ",\n" + recursive(), "feats", **how)


def feature_ctes(interval: str = "1h") -> str:
    return f"WITH RECURSIVE {TRADES},\n{bars(interval=interval)},\n{finite()},\n{recursive()}"


FEATURE_LONG = f"""held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY timestamp DESC) AS place FROM feats) WHERE place <= 1000),
tall AS (SELECT symbol, interval, timestamp, unnest([{', '.join(f"{{'feature': '{c}', 'value': {c}::DOUBLE}}" for c in VALUES)}], recursive := true) FROM held),
mo AS (SELECT symbol, interval, feature, count(*) AS rows, count(value) AS present, avg(value) AS mean,
              CASE WHEN min(value) = max(value) THEN 0 ELSE stddev_pop(value) END AS std, CASE WHEN min(value) = max(value) AND count(value) > 1 THEN 0 ELSE var_samp(value) END AS variance
       FROM tall GROUP BY 1, 2, 3),
od AS (SELECT symbol, interval, feature, count(*) AS n, max(z) AS zmax FROM (SELECT symbol, interval, feature, abs((value - mean) / std) AS z FROM tall JOIN mo USING (symbol, interval, feature) WHERE present >= 3 AND std > 0 AND value IS NOT NULL) WHERE z > 3 GROUP BY 1, 2, 3),
ou AS (SELECT symbol, interval, feature, present, coalesce(n, 0) AS n, zmax, 100.0 * coalesce(n, 0) / present AS pct FROM mo LEFT JOIN od USING (symbol, interval, feature) WHERE present >= 3),
ms AS (SELECT symbol, interval, any_value(rows) AS rows, sum(rows - present) AS total_missing, 100.0 * sum(rows - present) / (any_value(rows) * 58) AS miss FROM mo GROUP BY 1, 2),
co AS (SELECT a.symbol, a.interval, a.feature AS f1, b.feature AS f2, corr(a.value, b.value) AS c FROM tall a JOIN tall b ON a.symbol = b.symbol AND a.interval = b.interval AND a.timestamp = b.timestamp AND a.feature <> b.feature
       WHERE a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) > 1 AND min(a.value) < max(a.value) AND min(b.value) < max(b.value)),
cp AS (SELECT symbol, interval, count(*) FILTER (WHERE abs(c) > 0.95) // 2 AS pairs, max(abs(c)) AS cmax FROM co GROUP BY 1, 2),
va AS (SELECT symbol, interval, count(*) FILTER (WHERE variance < 1e-10) AS low, count(*) FILTER (WHERE variance = 0) AS flat FROM mo GROUP BY 1, 2),
it AS (SELECT symbol, interval, count(*) AS rows, count(*) FILTER (WHERE high < low) AS hl, count(*) FILTER (WHERE open < 0) AS o, count(*) FILTER (WHERE high < 0) AS h, count(*) FILTER (WHERE low < 0) AS l, count(*) FILTER (WHERE close < 0) AS c, count(*) FILTER (WHERE volume < 0) AS v FROM held GROUP BY 1, 2)"""

ALL_FINITE, ALL_VALUES = FINITE, VALUES
