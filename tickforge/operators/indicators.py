"""Indicators of finite and growing windows, all built in.  First values as the published definitions have them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import deviation, last_rows, mean, ratio, series, strict
from ..schema import AVERAGES, KEY

YEAR = math.sqrt(252)


def _steps(df: DataFrame) -> DataFrame:
    """Columns that several indicators share, computed once."""
    c, h, l, v = map(F.col, ("close", "high", "low", "volume"))
    before = F.lag("close").over(series())
    tp = (h + l + c) / 3
    return df.withColumns(
        {
            "__ret": ratio(c, before) - 1,
            "__rows": F.count("*").over(Window.partitionBy(*KEY)),
            "__row": F.row_number().over(series()) - 1,
            "__change": c - before,
            "__tp": tp,
            "__tp_change": tp - F.lag(tp).over(series()),
            "__avg_volume": mean(v, 20),
            "__low14": strict(F.min, l, 14),
            "__high14": strict(F.max, h, 14),
            "__low20": strict(F.min, l, 20),
            "__high20": strict(F.max, h, 20),
            "__buy": ratio(F.col("taker_buy_volume"), v) if "taker_buy_volume" in df.columns else F.lit(None).cast("double"),
        }
    )


def _cci() -> Column:
    tp, avg = F.col("__tp"), mean(F.col("__tp"), 20)
    held = F.collect_list("__tp").over(last_rows(20))
    off = F.aggregate(held, F.lit(0.0), lambda a, x: a + F.abs(x - avg)) / 20
    return F.when((F.col("__rows") > 20) & avg.isNotNull(), F.when(off > 0, (tp - avg) / (0.015 * off)).otherwise(0.0))


def finite_features(df: DataFrame) -> DataFrame:
    """The columns of schema.FINITE beside those of df (a series per symbol and interval)."""
    c, h, l, v, ret = map(F.col, ("close", "high", "low", "volume", "__ret"))
    so_far = series().rowsBetween(Window.unboundedPreceding, 0)
    base = _steps(df)
    many = F.col("__rows") > 20
    spread, mid = deviation(c, 20), mean(c, 20)
    width = 4 * spread
    range14, range20 = F.col("__high14") - F.col("__low14"), F.col("__high20") - F.col("__low20")
    moved = F.col("__tp") * v
    flow = lambda sign: F.sum(F.when(sign, moved).otherwise(0.0)).over(last_rows(14))
    up, down = flow(F.col("__tp_change") > 0), flow(F.col("__tp_change") < 0)
    first = base.withColumns(
        {f"sma_{n}": mean(c, n) for n in AVERAGES}
        | {
            "bb_middle": F.when(many, mid),
            "bb_upper": F.when(many, mid + 2 * spread),
            "bb_lower": F.when(many, mid - 2 * spread),
            "bb_width": F.when(many, width),
            "bb_percent": F.when(many, F.when(width > 0, (c - (mid - 2 * spread)) / width).otherwise(0.5)),
            "cci_20": _cci(),
            "__fast": F.when(range14 > 0, 100 * (c - F.col("__low14")) / range14).when(range14.isNotNull(), 0.0),
            "williams_r": F.when(range14 > 0, -100 * (F.col("__high14") - c) / range14).when(range14.isNotNull(), 0.0),
            "mfi_14": F.when(F.count("__tp_change").over(last_rows(14)) == 14, F.when(up + down < 1, 0.0).otherwise(100 * up / F.greatest(up + down, F.lit(1.0)))),
            "obv": F.sum(F.when(F.col("__row") == 0, v).otherwise(F.signum("__change") * v)).over(so_far),
            "vwap": ratio(F.sum(F.col("__tp") * v).over(so_far), F.sum(v).over(so_far)),
            "volume_ratio": ratio(v, F.col("__avg_volume")),
            "volatility_20": deviation(ret, 20) * YEAR,
            "volatility_50": deviation(ret, 50) * YEAR,
            "realized_volatility": mean(F.when((h > 0) & (l > 0), F.sqrt(F.pow(F.log(F.when(h > 0, h) / F.when(l > 0, l)), 2) / (4 * math.log(2)))), 20) * YEAR,
            "price_position": F.when(range20 > 0, (c - F.col("__low20")) / range20).otherwise(0.5),
            "trend_strength": ratio(c - mean(c, 50), mean(c, 50)),
            "volume_momentum": ratio(mean(v, 5), F.col("__avg_volume")),
            "buy_pressure": F.col("__buy"),
            "order_flow_imbalance": mean(F.col("__buy"), 20) - 0.5,
            "sharpe_ratio_20": F.when(deviation(ret, 20) > 0, mean(ret, 20) / deviation(ret, 20)).otherwise(0.0),
            "spread_ratio": ratio(h - l, c),
            "avg_spread": mean(h - l, 20),
            "spread_volatility": deviation(h - l, 20),
            "kyle_lambda": mean(F.when(v > 0, F.abs(F.coalesce("__change", F.lit(0.0))) / F.sqrt(F.when(v > 0, v))), 20),
            "amihud_illiquidity": mean(ratio(F.abs(ret), c * v), 20),
            "price_impact": ratio(F.abs(ret), ratio(v, F.col("__avg_volume"))),
            "volume_turnover": ratio(strict(F.sum, v, 20), strict(F.sum, v, 100)),
            "effective_spread": 2 * F.abs(c - (h + l) / 2),
        }
    )
    slow = first.withColumn("__slow", mean(F.col("__fast"), 3))
    out = slow.withColumn("stoch_d", mean(F.col("__slow"), 3)).withColumn("stoch_k", F.when(F.col("stoch_d").isNotNull(), F.col("__slow")))
    return out.drop(*(x for x in out.columns if x.startswith("__")))


def lag_features(df: DataFrame, columns: list[str], lags: tuple[int, ...] = (1, 2, 3, 5, 10)) -> DataFrame:
    """<column>_lag_<k>; unknown columns are passed over."""
    return df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(series()) for c in columns if c in df.columns for k in lags})


def rolling_features(df: DataFrame, columns: list[str], sizes: tuple[int, ...] = (5, 10, 20, 50)) -> DataFrame:
    """<column>_{mean,std,min,max}_<n>; unknown columns are passed over."""
    kinds = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    return df.withColumns({f"{c}_{k}_{n}": strict(f, F.col(c), n) for c in columns if c in df.columns for n in sizes for k, f in kinds.items()})
