"""Wire formats: REST rows, websocket envelopes, trades, order books, bus messages, line protocol, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import epoch_ns, from_epoch_ms
from ..schema import KEY, KLINE


def _kline(df: DataFrame, fields: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    kinds = {f.name: f.dataType for f in KLINE}
    return df.select(*(c.cast(kinds[n]).alias(n) for n, c in fields.items()), *keep)


def parse_rest_klines(df: DataFrame, value: str = "value") -> DataFrame:
    """Klines of JSON arrays of candle arrays, for rows with symbol and interval; such candles are closed.  Invalid JSON gives no rows."""
    rows = df.select(*KEY, F.explode(F.from_json(value, "array<array<string>>")).alias("r"))
    at = lambda i: F.try_element_at("r", F.lit(i + 1))
    number = lambda i: at(i).try_cast("double")
    fields = {"symbol": F.col("symbol"), "interval": F.col("interval"), "timestamp": from_epoch_ms(at(0).try_cast("long"))}
    fields |= {"open": number(1), "high": number(2), "low": number(3), "close": number(4), "volume": number(5), "quote_volume": number(7), "trades": at(8).try_cast("long"), "taker_buy_volume": number(9), "taker_buy_quote_volume": number(10), "is_closed": F.lit(True)}
    return _kline(rows, fields).where("timestamp is not null")


def parse_ws_klines(df: DataFrame, value: str = "value", stream: str = "stream", keep: tuple[str, ...] = ()) -> DataFrame:
    """Klines of websocket envelopes; symbol and interval come from the stream's name (sym@kline_iv).  Messages without a kline, or that aren't JSON, are passed over."""
    # o/c/l and v/V, q/Q, t/T differ in case alone: fields are taken by exact path
    path = lambda p: F.get_json_object(value, f"$.k.{p}")
    number = lambda p: path(p).try_cast("double")
    name = F.split(F.col(stream), "@")
    fields = {"symbol": F.upper(F.get(name, 0)), "interval": F.regexp_replace(F.get(name, 1), "^kline_", ""), "timestamp": from_epoch_ms(path("t").try_cast("long"))}
    fields |= {"open": number("o"), "high": number("h"), "low": number("l"), "close": number("c"), "volume": number("v"), "quote_volume": number("q"), "trades": path("n").try_cast("long"), "taker_buy_volume": number("V"), "taker_buy_quote_volume": number("Q"), "is_closed": path("x").try_cast("boolean")}
    return _kline(df.where(F.get_json_object(value, "$.k").isNotNull()), fields, keep).where("timestamp is not null")


def parse_trades(df: DataFrame, value: str = "value") -> DataFrame:
    """Trades of {T, p, q, m} messages, for rows with symbol and id."""
    m = F.from_json(value, "T long, p string, q string, m boolean")
    rows = df.select("symbol", "id", m.alias("m")).where("m.T is not null")
    return rows.select("symbol", from_epoch_ms(F.col("m.T")).alias("timestamp"), "id", F.col("m.p").try_cast("double").alias("price"), F.col("m.q").try_cast("double").alias("quantity"), F.col("m.m").alias("is_buyer_maker"))


def top_of_book(df: DataFrame) -> DataFrame:
    """best_bid, best_ask (NULL for an empty side), spread and mid_price (NULL unless both quotes are there and not 0) beside bids and asks of [price, quantity]."""
    best = lambda side: F.get(F.get(F.col(side), 0), 0).try_cast("double")
    bid, ask = F.col("best_bid"), F.col("best_ask")
    both = (bid != 0) & (ask != 0)
    return df.withColumns({"best_bid": best("bids"), "best_ask": best("asks")}).withColumns({"spread": F.when(both, ask - bid), "mid_price": F.when(both, (bid + ask) / 2)})


BUS = "symbol string, interval string, timestamp double, open double, high double, low double, close double, volume double, quote_volume double, trades long, taker_buy_volume double, taker_buy_quote_volume double, is_closed boolean"


def kline_to_message(df: DataFrame) -> DataFrame:
    """(key, value): kline:<symbol>:<interval>, and JSON of the thirteen fields with the time in seconds."""
    body = [(F.unix_micros("timestamp") / 1e6).alias("timestamp") if c == "timestamp" else F.col(c) for c in KLINE.names]
    return df.select(F.concat_ws(":", F.lit("kline"), *KEY).alias("key"), F.to_json(F.struct(*body)).alias("value"))


def message_to_kline(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Klines of bus messages; incomplete keys, times and prices are passed over."""
    key = F.split("key", ":")
    rows = df.select(*keep, key.alias("__key"), F.from_json("value", BUS).alias("v")).where((F.size("__key") == 3) & (F.get("__key", 0) == "kline") & F.col("v.timestamp").isNotNull() & F.col("v.close").isNotNull())
    fields = {"symbol": F.get("__key", 1), "interval": F.get("__key", 2), "timestamp": F.timestamp_micros(F.round(F.col("v.timestamp") * 1e6).cast("long"))}
    return _kline(rows, fields | {c: F.col(f"v.{c}") for c in KLINE.names[3:]}, keep)


def to_line_protocol(df: DataFrame, measurement: str, tag: str = "symbol", time: str = "timestamp") -> DataFrame:
    """One text line a row: measurement,tag fields time in ns.  Null fields are left out; rows without fields or time give no line."""

    def written(c: str, kind: str) -> Column:
        v = F.col(c)
        text = F.concat(v.cast("string"), F.lit("i")) if kind in ("int", "bigint", "smallint", "tinyint") else F.when(v, "T").otherwise("F") if kind == "boolean" else F.concat(F.lit('"'), F.regexp_replace(v.cast("string"), r'(["\\])', r"\\$1"), F.lit('"')) if kind == "string" else F.when(~F.isnan(v), v.cast("string"))
        return F.when(v.isNotNull(), F.concat(F.lit(f"{c}="), text))

    fields = F.concat_ws(",", *(written(c, kind) for c, kind in df.dtypes if c not in (tag, time)))
    escaped = F.regexp_replace(F.col(tag), r"([,= ])", r"\\$1")
    rows = df.select(fields.alias("f"), escaped.alias("t"), epoch_ns(time).alias("ns")).where("f <> '' and ns is not null")
    return rows.select(F.concat(F.lit(f"{measurement},{tag}="), "t", F.lit(" "), "f", F.lit(" "), F.col("ns").cast("string")).alias("value"))


def quality_to_json(report: DataFrame) -> DataFrame:
    """(key, value): quality:<symbol>:<interval>, and the report as JSON."""
    return report.select(F.concat_ws(":", F.lit("quality"), *KEY).alias("key"), F.to_json(F.struct(*report.columns)).alias("value"))
