"""Structured Streaming: closed klines, monotonic bars, features on each bar, upserting sinks, bars from trades."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.bars import _span, trade_bar_columns
from ..operators.clean import closed_only, dedupe_last
from ..operators.quality import numeric_columns
from ..operators.quality_state import PERIOD, STATE, merged_states, partial_states, period_of, state_reports
from ..schema import FEATURES, KEY, KLINE, VALUES
from ..sources.messages import message_to_kline, parse_ws_klines
from ..sources.scratch import settled
from ..sources.tables import upsert_table
from .state import keyed_state, later_rows, ring_features, stream_clean  # noqa: F401


def stream_klines(source: DataFrame, kind: str = "websocket", keep: tuple[str, ...] = ()) -> DataFrame:
    """Closed klines of a stream of websocket messages (stream, value) or bus messages (key, value)."""
    parsed = parse_ws_klines(source, keep=keep) if kind == "websocket" else message_to_kline(source, keep)
    return closed_only(parsed)


def monotonic_bars(klines: DataFrame, order_col: str | None = None) -> DataFrame:
    """Of each series only bars strictly later than the last kept one: duplicates and late bars go.  State: one time a series, in the checkpoint.

    order_col says in what order bars arrived (an offset, a sequence number); a bar that came after a later one
    then goes, wherever triggers fall.  Without it, the bars of a trigger count as come in order of time.
    """
    schema = klines.schema

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = later_rows(batches, state.get[0] if state.exists else None, order_col)
        if len(rows):
            state.update((int(rows["timestamp"].iloc[-1].value // 1000),))
            yield rows

    return klines.groupBy(*KEY).applyInPandasWithState(run, schema, T.StructType([T.StructField("last", T.LongType())]), "append", GroupStateTimeout.NoTimeout)


def deduplicated(klines: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """A gentler rule: late bars stay, repeats within the lateness go."""
    return klines.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark([*KEY, "timestamp"])


def _each_batch(klines: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = klines.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def upsert_sink(rows: DataFrame, path: str, checkpoint: str, order_col: str | None = None, every: str | None = "15 seconds") -> StreamingQuery:
    """Each trigger's rows upserted into a table; later triggers win, and of a trigger's rows of one time the last by order_col, without it the largest by its columns (as in upsert)."""

    def write(batch: DataFrame, _: int) -> None:
        upsert_table(batch.sparkSession, path, dedupe_last(batch, order_col).drop(order_col) if order_col else batch)

    return _each_batch(rows, write, checkpoint, every)


def stream_features(klines: DataFrame, table: str, out: str, checkpoint: str, lookback: int = 300, every: str | None = "15 seconds", order_col: str | None = None, version: int = 2, idle_ms: int | None = None) -> StreamingQuery:
    """On new bars: upsert them, and upsert each new bar's features from its own newest `lookback` bars, however many a trigger brings.

    The newest bars of a series are its state: no table is read for them, and a bar costs the same in a trigger
    of many.  Late and repeated bars go as in monotonic_bars.  Null prices are passed over by recursions; stream_clean fills them.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark, rows = batch.sparkSession, settled(batch)
        upsert_table(spark, table, rows.select(*KLINE.names))
        made = rows.where("has_features").select(*KEY, "timestamp", *(F.nanvl(F.col(f"feature_{c}"), F.lit(None)).alias(c) for c in VALUES), F.lit(version).cast("long").alias("feature_version"))
        upsert_table(spark, out, made.select(*FEATURES.names))

    with keyed_state(klines.sparkSession):
        return _each_batch(ring_features(klines, lookback, order_col=order_col, idle_ms=idle_ms), write, checkpoint, every)


def stream_quality(features: DataFrame, table: str, states: str, reports: str, checkpoint: str, seconds: int = 86_400, every: str | None = "10 minutes", low: float = 70.0) -> StreamingQuery:
    """Reports of each series and period of time, kept up trigger by trigger: features are upserted into table, and what reports need is added to states.

    A trigger writes the states of its own rows, and reports anew on the periods that it meets: states of all triggers are merged,
    and outliers counted in those periods' days of the table.  Both go into a folder of the trigger's number, so a trigger
    that is done again replaces what it wrote.  Each row must come once, as ring_features emits them.  latest_reports reads the outcome.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, settled(batch.select(*FEATURES.names))
        span = rows.agg(F.min(period_of("timestamp", seconds)).alias("lo"), F.max(period_of("timestamp", seconds)).alias("hi")).first()
        if span["lo"] is None:
            return
        upsert_table(spark, table, rows)
        with_period = lambda df: df.withColumn("period", period_of("timestamp", seconds))
        new = partial_states(with_period(rows)).withColumn("day", F.to_date("period"))
        new.write.mode("overwrite").partitionBy("day").parquet(f"{states}/trigger={number}")
        met = with_period(rows).select(*PERIOD).distinct()
        ends = [F.to_date(F.lit(x)) for x in (span["lo"], span["hi"])]
        held = spark.read.schema(STATE + ", trigger int, day date").parquet(states).where(F.col("day").between(*ends) & (F.col("trigger") <= number)).drop("trigger", "day")
        merged = settled(merged_states(held.join(met, list(PERIOD), "left_semi"), len(numeric_columns(rows))))
        near = spark.read.parquet(table).where(F.col("date").between(ends[0], F.date_add(ends[1], seconds // 86_400 + 1))).select(*FEATURES.names)
        state_reports(with_period(near).join(met, list(PERIOD), "left_semi"), merged, low).write.mode("overwrite").parquet(f"{reports}/trigger={number}")

    return _each_batch(features, write, checkpoint, every)


def latest_reports(reports: DataFrame) -> DataFrame:
    """Of each series and period the report of the last trigger that met it; reports: the folder of stream_quality."""
    whole = F.struct(*(c for c in reports.columns if c != "trigger"))
    return reports.groupBy(*PERIOD).agg(F.max_by(whole, "trigger").alias("r")).select("r.*")


def stream_bars(trades: DataFrame, interval: str, lateness: str = "1 minute") -> DataFrame:
    """Bars of a stream of trades; a bar comes out once the watermark has passed its end."""
    bars = trades.withWatermark("timestamp", lateness).groupBy("symbol", F.window("timestamp", _span(interval)).alias("w")).agg(*trade_bar_columns())
    return bars.withColumns({"interval": F.lit(interval), "timestamp": F.col("w.start"), "is_closed": F.lit(True)}).select(*KLINE.names)
