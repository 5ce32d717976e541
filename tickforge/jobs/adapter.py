"""The given tables as market data: events are trades, and lines of orders are daily trades of many suppliers.

Times in the tables have no zone and are UTC: frames are to be made within in_utc.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bars import bars_from_trades


@contextmanager
def in_utc(spark: SparkSession) -> Iterator[None]:
    """The session's zone is UTC within, and as it was after: frames keep the zone that they were made in."""
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades: type is the symbol, value the price, props.k the quantity; odd users are makers on the buying side."""
    quantity = F.get_json_object("props", "$.k").cast("double")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_id").alias("id"), F.col("value").alias("price"),
        quantity.alias("quantity"), (F.col("user_id") % 2 != 0).alias("is_buyer_maker"),
    )


def bars(spark: SparkSession, sf_dir: str, interval: str = "1h") -> DataFrame:
    return bars_from_trades(trades(spark, sf_dir), interval)


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each supplier's order lines: many symbols with some hundred bars each."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_suppkey").cast("string").alias("symbol"), F.col("l_shipdate").cast("timestamp").alias("timestamp"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").cast("double").alias("quantity"), (F.col("l_linenumber") % 2 != 0).alias("is_buyer_maker"),
    )
    return bars_from_trades(lines, "1d")
