"""Backward as-of joins, and features of several timeframes side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import interval_minutes


def asof_backward(base: DataFrame, others: dict[str, DataFrame], by_day: bool = True) -> DataFrame:
    """For each row of base (symbol, timestamp, ...) and each other, by name, the whole latest row of the other that isn't later, as a struct.

    Nulls in that row stay nulls.  All others are met in one pass: rows are put together and
    each other's last struct is carried on.  So that a symbol's history needn't be one task's,
    rows are grouped by symbol and day, and each day gets what the days before left.
    """
    if not others:
        return base
    keys = ("symbol", "timestamp")
    values = [c for c in base.columns if c not in keys]
    structs = {name: [c for c in other.columns if c not in keys] for name, other in others.items()}
    kinds = {name: other.select(F.struct(*structs[name]).alias("x")).schema["x"].dataType for name, other in others.items()}

    def rows(df: DataFrame, side: int, name: str | None) -> DataFrame:
        own = F.struct(*values) if name is None else F.lit(None).cast(base.select(F.struct(*values).alias("x")).schema["x"].dataType)
        return df.select(*keys, F.lit(side).alias("__side"), own.alias("__base"), *((F.struct(*structs[n]) if n == name else F.lit(None).cast(kinds[n])).alias(f"__{n}") for n in others))

    both = rows(base, 1, None)
    for name, other in others.items():
        both = both.unionByName(rows(other, 0, name))
    held = [f"__{n}" for n in others]
    if by_day:
        both = both.withColumn("__day", F.to_date("timestamp"))
        order = F.struct("timestamp", "__side")
        ends = both.groupBy("symbol", "__day").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in held))
        earlier = Window.partitionBy("symbol").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
        left = ends.select("symbol", "__day", *(F.last(c, True).over(earlier).alias(f"{c}_before") for c in held))
        within = Window.partitionBy("symbol", "__day").orderBy("timestamp", "__side").rowsBetween(Window.unboundedPreceding, 0)
        both = both.join(left, ["symbol", "__day"])
        found = {c: F.coalesce(F.last(c, True).over(within), F.col(f"{c}_before")) for c in held}
    else:
        within = Window.partitionBy("symbol").orderBy("timestamp", "__side").rowsBetween(Window.unboundedPreceding, 0)
        found = {c: F.last(c, True).over(within) for c in held}
    met = both.select(*keys, "__side", "__base", *(x.alias(c) for c, x in found.items())).where("__side = 1")
    return met.select(*keys, *(F.col(f"__base.{c}").alias(c) for c in values), *(F.col(f"__{n}").alias(n) for n in others))


def multi_timeframe(frames: dict[str, DataFrame], use_close_time: bool = False) -> DataFrame:
    """The smallest interval's rows with all other intervals' columns as <column>_<interval>.

    By default a bar counts from its open time (so it looks ahead until the bar is done); with use_close_time, from its close.  Unknown names sort as a day.  Equal spans join
    on equal times.
    """
    if not frames:
        raise ValueError("no timeframes")
    order = sorted(frames, key=lambda name: interval_minutes(name, 1440))
    smallest, *rest = order
    drop = lambda df: df.drop("interval")
    span = interval_minutes(smallest, 60)
    same = [n for n in rest if interval_minutes(n, 60) == span]
    others = {}
    for name in rest:
        frame = drop(frames[name])
        if use_close_time and name not in same:
            frame = frame.withColumn("timestamp", F.timestamp_add("MINUTE", F.lit(interval_minutes(name, 60) - span), "timestamp"))
        others[name] = frame
    met = asof_backward(drop(frames[smallest]), {n: f for n, f in others.items() if n not in same})
    values = {n: [c for c in others[n].columns if c not in ("symbol", "timestamp")] for n in rest}
    out = met.select(*drop(frames[smallest]).columns, *(F.col(f"`{n}`.{c}").alias(f"{c}_{n}") for n in rest if n not in same for c in values[n]))
    for name in same:
        out = out.join(others[name].withColumnsRenamed({c: f"{c}_{name}" for c in values[name]}), ["symbol", "timestamp"], "left")
    return out
