"""Column layouts of klines, trades, books and features.  NULL is the only missing value."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ("symbol", "interval")
PRICES = ("open", "high", "low", "close")
SUMS = ("volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")

KLINE = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("interval", T.StringType()), T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in (*PRICES, "volume", "quote_volume")]
    + [T.StructField("trades", T.LongType()), T.StructField("taker_buy_volume", T.DoubleType()), T.StructField("taker_buy_quote_volume", T.DoubleType()), T.StructField("is_closed", T.BooleanType())]
)
TRADE = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampType()), T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("quantity", T.DoubleType()), T.StructField("is_buyer_maker", T.BooleanType())])

AVERAGES = (10, 20, 50, 100, 200)
FINITE = (
    *(f"sma_{n}" for n in AVERAGES), "bb_upper", "bb_middle", "bb_lower", "bb_width", "bb_percent", "cci_20", "stoch_k", "stoch_d", "williams_r", "mfi_14",
    "obv", "vwap", "volume_ratio", "volatility_20", "volatility_50", "realized_volatility", "price_position", "trend_strength", "volume_momentum",
    "buy_pressure", "order_flow_imbalance", "sharpe_ratio_20", "spread_ratio", "avg_spread", "spread_volatility", "kyle_lambda", "amihud_illiquidity",
    "price_impact", "volume_turnover", "effective_spread",
)
RECURSIVE = (*(f"ema_{n}" for n in AVERAGES), "macd", "macd_signal", "macd_hist", "momentum_score", "rsi_14", "rsi_21", "atr_14", "atr_21", "plus_di", "minus_di", "adx_14")
BASE = ("open", "high", "low", "close", "volume")
VALUES = (*BASE, *FINITE, *RECURSIVE)
FEATURES = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("interval", T.StringType()), T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in VALUES]
    + [T.StructField("feature_version", T.LongType())]
)
