"""Long series cut into blocks of equal numbers of rows, so that no task holds a series' history.

Rows are numbered within cells of time, ahead of which a small table of counts gives the rows
of earlier cells.  A block takes the `halo` rows before it along; with halo <= block a row
goes to two blocks at most.  Rows without symbol, interval or timestamp are in no series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import interval_ms
from ..schema import KEY


def placed(df: DataFrame, cell_rows: int) -> DataFrame:
    """df with `place`, the number of rows before in its series, and `total`, the series' rows.

    A cell spans the time of cell_rows bars: more rows than that are in one only if times repeat.
    """
    span = interval_ms("interval") * F.lit(1000 * cell_rows)
    celled = df.withColumn("cell", F.call_function("div", F.unix_micros("timestamp"), span))
    ahead = Window.partitionBy(*KEY).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = celled.groupBy(*KEY, "cell").agg(F.count("*").alias("n"))
    before = counts.select(*KEY, "cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"), F.sum("n").over(Window.partitionBy(*KEY)).alias("total"))
    place = F.col("ahead") + F.row_number().over(Window.partitionBy(*KEY, "cell").orderBy("timestamp")) - 1
    return celled.join(before, [*KEY, "cell"]).withColumn("place", place).drop("cell", "ahead")


def in_blocks(df: DataFrame, block: int, halo: int) -> DataFrame:
    """Rows of placed with `series` (their symbol), `of` (a block), `own` (false: halo); symbol names series and block."""
    if not 0 < halo <= block:
        raise ValueError("a halo is of at least one row and at most a block")
    held = placed(df, block)
    home = F.call_function("div", F.col("place"), F.lit(block))
    ends = (F.col("place") % block >= block - halo) & ((home + 1) * block < F.col("total"))
    dealt = held.withColumn("of", F.explode(F.when(ends, F.array(home, home + 1)).otherwise(F.array(home)))).withColumn("own", F.col("of") == home)
    return dealt.withColumn("series", F.col("symbol")).withColumn("symbol", F.concat("symbol", F.lit("@"), F.col("of").cast("string")))


def with_running_sums(blocks: DataFrame, terms: dict[str, Column], start: DataFrame | None = None) -> DataFrame:
    """blocks with, for each name, the sum of its term over the series' rows up to each own row.

    Blocks are summed first; sums of earlier blocks come by a join of one row a block.  start: (series, interval,
    <name>_start) of sums that rows before these had, where there were any.
    """
    totals = blocks.groupBy(*KEY, "series", "of").agg(*(F.sum(F.when(F.col("own"), x)).alias(f"{n}_before") for n, x in terms.items()))
    earlier = Window.partitionBy("series", "interval").orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*KEY, "series", *(F.sum(f"{n}_before").over(earlier).alias(f"{n}_before") for n in terms))
    if start is not None:
        plus = {f"{n}_before": F.coalesce(F.col(f"{n}_before") + F.col(f"{n}_start"), f"{n}_before", f"{n}_start") for n in terms}
        before = before.join(start, ["series", "interval"], "left").withColumns(plus)
    before = before.select(*KEY, *(f"{n}_before" for n in terms))
    so_far = Window.partitionBy(*KEY).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    joined = blocks.join(before, list(KEY))
    summed = {n: F.sum(F.when(F.col("own"), x)).over(so_far) for n, x in terms.items()}
    return joined.withColumns({n: F.coalesce(x + F.col(f"{n}_before"), x, F.col(f"{n}_before")) for n, x in summed.items()}).drop(*(f"{n}_before" for n in terms))
