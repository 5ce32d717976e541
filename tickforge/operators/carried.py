"""Features that go on from a table of states: a run reads new bars and a few rows of lookback.

A series' state is one row: the time of its last bar, the time of the bar `LOOKBACK` rows back, its
number of bars, the value of each recursion, and the sums without end.  Long stretches are cut
into blocks, which take `LOOKBACK` rows before them along for the finite windows; where their
recursions start follows exactly from affine maps of the blocks before, a row a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.carried import FIRST_ALPHAS, FIRST_LEVEL, SECOND_ALPHAS, SEEDED, carried_columns, composed, first_level, second_level
from ..functions.windows import ratio, series
from ..schema import BASE, FEATURES, KEY, RECURSIVE
from .blocks import in_blocks, with_running_sums
from .clean import annotate, non_finite_to_null, require_columns
from .indicators import finite_features

LOOKBACK = SEEDED
BLOCK = 131_072
STATES = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("interval", T.StringType()), T.StructField("timestamp", T.TimestampType()), T.StructField("since", T.TimestampType()), T.StructField("bars", T.LongType())]
    + [T.StructField("carried", T.ArrayType(T.DoubleType()))]
    + [T.StructField(c, T.DoubleType()) for c in ("sum_signed", "sum_paid", "sum_volume")]
)
_PRICES = ("high", "low", "close")


def _split(rows: pd.DataFrame, starts: pd.DataFrame) -> tuple[pd.DataFrame, list[np.ndarray], int, np.ndarray | None]:
    """(rows in order of time, their prices, how many come before the block's own, what its recursions start from)."""
    rows = rows.sort_values("timestamp", kind="stable").reset_index(drop=True)
    return rows, [rows[c].to_numpy(float) for c in _PRICES], int((~rows["own"]).sum()), np.array(starts["start"].iloc[0], float) if len(starts) else None


def _maps(level: int):
    """The block's number of own rows and last values of a level: from its seeds or state if it is a series' first, else from a start of 0."""
    k = len(FIRST_LEVEL)

    def run(rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["series", "interval", "of", "rows", "ends"])
        rows, prices, skip, start = _split(rows, starts)
        of = int(rows["of"].iloc[0])
        seeds = start is None and of == 0
        if level == 1:
            values = first_level(*prices, skip, None if seeds else start[:k] if of == 0 else np.zeros(k))
        else:
            first = first_level(*prices, skip, None if seeds else start[:k])
            values = second_level(first, None if seeds else start[k:] if of == 0 else np.zeros(len(SECOND_ALPHAS)))
        return pd.DataFrame({"series": rows["series"].iloc[:1], "interval": rows["interval"].iloc[:1], "of": [of], "rows": [len(rows) - skip], "ends": [values[:, -1].tolist()]})

    return run


def _composed(alphas: np.ndarray):
    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("of")
        starts = composed(blocks["rows"].to_numpy(), np.array(blocks["ends"].tolist()), alphas)
        return pd.DataFrame({"symbol": blocks["series"] + "@" + blocks["of"].astype(str), "interval": blocks["interval"], "of": blocks["of"], "start": list(starts)}).iloc[1:]

    return run


_MAP, _START = "series string, interval string, of long, rows long, ends array<double>", "symbol string, interval string, of long, start array<double>"


def block_starts(blocks: DataFrame, first: DataFrame) -> DataFrame:
    """(symbol, interval, start) of all blocks but those of unseen series: first (of first blocks with a state), and by composition the later blocks of long series.

    blocks: own rows of long series and one row before them, as in_blocks gives; three narrow columns are read twice.
    """
    slim = blocks.select(*KEY, "timestamp", "series", "of", "own", *_PRICES)
    known = first
    for level, alphas in ((1, FIRST_ALPHAS), (2, SECOND_ALPHAS)):
        ends = slim.groupBy(*KEY).cogroup(known.groupBy(*KEY)).applyInPandas(_maps(level), _MAP)
        later = ends.groupBy("series", "interval").applyInPandas(_composed(alphas), _START).select(*KEY, "start")
        if level == 1:
            level_one, known = later, first.unionByName(later)
        else:
            both = level_one.withColumnRenamed("start", "one").join(later, list(KEY)).select(*KEY, F.concat("one", "start").alias("start"))
    return first.unionByName(both)


def _kernel(rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """A block's rows with recursive columns; its last row also has the values to carry and the time LOOKBACK rows back."""
    if not len(rows):
        return rows.assign(**{c: np.zeros(0) for c in RECURSIVE}, carried=None, since=pd.NaT)
    rows, prices, skip, start = _split(rows, starts)
    found, end = carried_columns(*prices, skip, start)
    own = rows.iloc[skip:].reset_index(drop=True).assign(**found)
    own["carried"] = [None] * (len(own) - 1) + [end.tolist()]
    own["since"] = pd.Series([pd.NaT] * (len(own) - 1) + [rows["timestamp"].iloc[max(0, len(rows) - LOOKBACK)]], dtype=rows["timestamp"].dtype)
    return own


def features_carried(klines: DataFrame, states: DataFrame, least_rows: int = 20, version: int = 2, block: int = BLOCK) -> DataFrame:
    """schema.FEATURES of the bars behind each series' state, each as of its whole history; a series' last row also has its new state in `state`.

    klines: of a series with a state the bars from its `since` on, of others all; states: STATES, of series in klines or not,
    a series once.  A state of fewer than LOOKBACK bars says nothing of a series, whose bars are all there then.
    """
    if block <= LOOKBACK:
        raise ValueError("a block is longer than the longest window")
    wanted = [*KEY, "timestamp", *BASE, *(c for c in ("taker_buy_volume",) if c in klines.columns)]
    ripe = states.where((F.col("bars") >= LOOKBACK) & F.col("carried").isNotNull())
    until = ripe.select(*KEY, F.col("timestamp").alias("until"), F.col("bars").alias("bars_before"))
    met = require_columns(klines).select(*wanted).join(until, list(KEY), "left")
    held = in_blocks(met, block, LOOKBACK).withColumn("own", F.col("own") & (F.col("until").isNull() | (F.col("timestamp") > F.col("until"))))
    bars = F.when(F.col("until").isNull(), F.col("total")).otherwise(F.col("bars_before") + F.col("total") - LOOKBACK)
    held = held.withColumn("bars", bars.cast("long")).where(F.col("bars") >= least_rows)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    stepped = held.withColumn("change", F.col("close") - F.lag("close").over(series()))
    signed = F.when(F.col("until").isNull() & (F.col("place") == 0), F.col("volume")).otherwise(F.signum("change") * F.col("volume"))
    before = ripe.select(F.col("symbol").alias("series"), "interval", *(F.col(c).alias(f"{c}_start") for c in ("sum_signed", "sum_paid", "sum_volume")))
    summed = with_running_sums(stepped, {"sum_signed": signed, "sum_paid": typical * F.col("volume"), "sum_volume": F.col("volume")}, before)
    finite = finite_features(summed).withColumns({"obv": F.col("sum_signed"), "vwap": ratio(F.col("sum_paid"), F.col("sum_volume"))})
    starts = ripe.select(F.concat("symbol", F.lit("@0")).alias("symbol"), "interval", F.col("carried").alias("start"))
    if not met.groupBy(*KEY).count().where(F.col("count") > block).isEmpty():
        starts = block_starts(held.where(F.col("total") > block), starts)
    out = T.StructType([f for f in finite.schema if f.name not in RECURSIVE] + [T.StructField(c, T.DoubleType()) for c in RECURSIVE] + [T.StructField("carried", T.ArrayType(T.DoubleType())), T.StructField("since", T.TimestampType())])
    found = finite.groupBy(*KEY).cogroup(starts.groupBy(*KEY)).applyInPandas(_kernel, out).withColumn("symbol", F.col("series"))
    state = F.when(F.col("place") == F.col("total") - 1, F.struct(*STATES.names))
    return annotate(non_finite_to_null(found.withColumn("state", state)), version).select(*FEATURES.names, "state")


def new_states(found: DataFrame) -> DataFrame:
    """STATES of the series of features_carried's rows."""
    return found.where("state is not null").select("state.*")
