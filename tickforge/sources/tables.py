"""Kline and feature tables: partitioned Parquet in ranges of symbols, spans of time, newest rows, and upserts of touched ranges only."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import interval_ms
from ..schema import KEY
from .scratch import settled


FOLDERS = ("interval", "date", "slot")
SLOT_ROWS = 1 << 20  # rows of a day and interval that come into one folder, and so into one task and file
RANGES = "interval string, date date, slot int, lo string"


def read_ranges(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(RANGES of the table under path, their version): lo is the first symbol of a slot, the empty text for slot 0."""
    try:
        held = spark.read.schema(RANGES + ", version int").parquet(f"{path}/_ranges")
        version = held.agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        version = None
    if version is None:
        return spark.createDataFrame([], RANGES), 0
    return held.where(F.col("version") == version).drop("version"), version


def _ranged(df: DataFrame, path: str, slot_rows: int) -> DataFrame:
    """df (with date) and the slot of each row.  Days that the table has keep their ranges; those of new days are made from df and written first."""
    spark = df.sparkSession
    known, version = read_ranges(spark, path)
    same = lambda a, b: a["interval"].eqNullSafe(b["interval"]) & a["date"].eqNullSafe(b["date"])
    days = known.where("slot = 0")
    counts = df.groupBy("interval", "date", "symbol").agg(F.count("*").alias("n"))
    counts = counts.join(days, same(counts, days), "left_anti")
    before = F.sum("n").over(Window.partitionBy("interval", "date").orderBy("symbol").rowsBetween(Window.unboundedPreceding, -1))
    cells = counts.withColumn("cell", F.floor(F.coalesce(before, F.lit(0)) / slot_rows))
    starts = cells.groupBy("interval", "date", "cell").agg(F.min("symbol").alias("lo"))
    place = F.row_number().over(Window.partitionBy("interval", "date").orderBy("cell")) - 1
    made = settled(starts.select("interval", "date", place.alias("slot"), F.when(place == 0, "").otherwise(F.col("lo")).alias("lo")))
    if not made.isEmpty():
        known = known.unionByName(made)
        known.coalesce(1).write.parquet(f"{path}/_ranges/version={version + 1}")
    cut = known.where("slot > 0")  # days of one slot need no look
    if cut.isEmpty():
        return df.withColumn("slot", F.lit(0))
    los = cut.groupBy("interval", "date").agg(F.collect_list("lo").alias("los"))
    met = df.alias("d").join(los.alias("r"), F.col("d.interval").eqNullSafe(F.col("r.interval")) & F.col("d.date").eqNullSafe(F.col("r.date")), "left")
    slot = F.when(F.col("los").isNull() | F.col("d.symbol").isNull(), 0).otherwise(F.size(F.filter("los", lambda lo: lo <= F.col("d.symbol"))))
    return met.select("d.*", slot.cast("int").alias("slot"))


def write_table(df: DataFrame, path: str, mode: str = "append", slot_rows: int = SLOT_ROWS) -> None:
    """Partitioned by interval, date and slot, one task's rows a folder.

    Slots are ranges of symbols of about slot_rows rows; a day's ranges are made when it is first written, kept in a
    small table beside the data (_ranges, hidden from readers), and stay as they are, so rows of a symbol are always in the same folders.
    slot_rows of 0: no slots, as tables have that were laid out without them.
    """
    dated = df.withColumn("date", F.to_date("timestamp"))
    _write_folders(_ranged(dated, path, slot_rows) if slot_rows else dated, path, mode, FOLDERS if slot_rows else FOLDERS[:2])


def _write_folders(dated: DataFrame, path: str, mode: str, folders: tuple[str, ...]) -> None:
    dealt = dated.repartition(*folders).sortWithinPartitions(*folders, "symbol", "timestamp")
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows, with date and slot, by which readers prune."""
    return spark.read.parquet(path)


def klines_between(df: DataFrame, symbol: str, interval: str, start: datetime, end: datetime, limit: int | None = None) -> DataFrame:
    """Rows of [start, end) in order of time; days outside are pruned where the table has dates."""
    rows = df.where((F.col("symbol") == symbol) & (F.col("interval") == interval) & (F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    if "date" in df.columns:
        rows = rows.where((F.col("date") >= F.to_date(F.lit(start))) & (F.col("date") <= F.to_date(F.lit(end))))
    rows = rows.orderBy("timestamp")
    return rows.limit(limit) if limit is not None else rows


def latest_n(df: DataFrame, n: int = 1000, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """The newest n rows of each series, of [start, end] where given."""
    if start is not None:
        df = df.where(F.col("timestamp") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("timestamp") <= F.lit(end))
    newest = Window.partitionBy(*KEY).orderBy(F.col("timestamp").desc())
    return df.withColumn("__place", F.row_number().over(newest)).where(F.col("__place") <= n).drop("__place")


def latest_rows(df: DataFrame) -> DataFrame:
    """The last row of each series, by partial aggregation."""
    whole = F.max_by(F.struct(*df.columns), "timestamp").alias("r")
    return df.groupBy(*KEY).agg(whole).select("r.*")


def upsert(existing: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = (*KEY, "timestamp")) -> DataFrame:
    """Rows of both; of equal keys the incoming one, of equal incoming ones the largest by their columns in order (dedupe_last keeps the latest arrival instead)."""
    both = existing.withColumn("__side", F.lit(0)).unionByName(incoming.withColumn("__side", F.lit(1)))
    order = Window.partitionBy(*keys).orderBy(F.col("__side").desc(), *(F.col(c).desc() for c in incoming.columns if c not in keys))
    return both.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place", "__side")


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, slot_rows: int = SLOT_ROWS) -> None:
    """Upsert into a table that write_table laid out; only the slots of touched intervals and dates that incoming rows meet are replaced, and only their span of dates is read."""
    incoming = incoming.withColumn("date", F.to_date("timestamp"))
    span = incoming.agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count(F.lit(1)).alias("rows")).first()
    if not span["rows"]:
        return
    try:
        held = spark.read.parquet(path)
    except AnalysisException as error:  # the first batch finds no table
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        write_table(upsert(incoming.limit(0), incoming).drop("date"), path, "overwrite", slot_rows)
        return
    slots = "slot" in held.columns
    folders = FOLDERS if slots else FOLDERS[:2]
    incoming = _ranged(incoming, path, slot_rows) if slots else incoming
    touched = incoming.select(*(F.col(c).alias(f"__{c}") for c in folders)).distinct()  # however many
    within = F.col("date").isNull() | F.col("date").between(*(F.lit(span[k]).cast("date") for k in ("lo", "hi")))  # prunes folders before the read
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in folders]
    merged = settled(upsert(held.where(within).join(touched, same, "left_semi").select(*incoming.columns), incoming))
    if slots:
        _write_folders(merged, path, "overwrite", folders)
    else:
        write_table(merged.drop("date"), path, "overwrite", 0)


MOST_INTERVALS = 64  # names of intervals that a condition lists


def since_by_interval(table: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of a table (as write_table lays out, or without dates) of the intervals of firsts (interval, first: a time), each from its earliest date on.

    The condition names intervals and dates, so folders of other intervals and earlier dates aren't read.
    Beyond MOST_INTERVALS names, which no known set of intervals has, it is one date for all.
    """
    found = firsts.groupBy("interval").agg(F.unix_micros(F.min("first")).alias("first")).where(F.col("first").isNotNull()).limit(MOST_INTERVALS + 1).collect()
    if not found:
        return table.limit(0)
    time = lambda us: F.timestamp_micros(F.lit(us))
    at = (lambda us: F.col("date") >= F.to_date(time(us))) if "date" in table.columns else (lambda us: F.col("timestamp") >= time(us))
    if len(found) > MOST_INTERVALS:
        return table.where(at(firsts.agg(F.unix_micros(F.min("first"))).first()[0]))
    meets = [(F.col("interval") == r["interval"]) & at(r["first"]) for r in found]
    held = meets[0]
    for more in meets[1:]:
        held = held | more
    return table.where(held)


def lookback_rows(table: DataFrame, new: DataFrame, n: int) -> DataFrame:
    """Rows of a table (as write_table lays out) of the series of new: for each series at least the n rows up to its oldest new one, and all later ones.

    The dates of twice n intervals are read, of each interval its own.  Series that hold fewer than n rows there (gaps, or a
    short history) are looked for further back, four times as far each time, until they have n rows or their interval's
    first date is reached; only folders of their intervals are read for them.
    """
    ms = interval_ms("interval")
    wanted = settled(new.groupBy(*KEY).agg(F.min("timestamp").alias("__oldest")))
    if wanted.isEmpty():
        return table.limit(0)
    back, found, edge = 2 * n, None, None
    while True:
        reach = wanted.withColumn("first", F.timestamp_micros(F.unix_micros("__oldest") - 1000 * back * ms))
        near = since_by_interval(table, reach).join(reach, list(KEY)).where(F.col("date") >= F.to_date("first"))
        full = near.where(F.col("timestamp") <= F.col("__oldest")).groupBy(*KEY).count().where(F.col("count") >= n).select(*KEY)
        if edge is None:
            edge = settled(since_by_interval(table.select("interval", "date"), wanted.select("interval", F.lit("0001-01-01").cast("timestamp").alias("first"))).groupBy("interval").agg(F.min("date").alias("__edge")))
        whole = reach.join(F.broadcast(edge), "interval").where(F.to_date("first") <= F.col("__edge")).select(*KEY)  # an interval a row
        done = settled(full.union(whole).distinct())
        rows = near.join(done, list(KEY), "left_semi").select(*table.columns)
        found = rows if found is None else found.unionByName(rows)
        wanted = settled(wanted.join(done, list(KEY), "left_anti"))
        if wanted.isEmpty():
            return found
        back *= 4
