"""Intervals and epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Milliseconds of each known interval; fixed values.
INTERVAL_MS = {
    "1m": 60_000, "3m": 180_000, "5m": 300_000, "15m": 900_000, "30m": 1_800_000, "1h": 3_600_000, "2h": 7_200_000, "4h": 14_400_000,
    "6h": 21_600_000, "8h": 28_800_000, "12h": 43_200_000, "1d": 86_400_000, "3d": 259_200_000, "1w": 604_800_000, "1M": 2_592_000_000,
}
UNKNOWN_MS = 60_000


def interval_ms(name: Column | str) -> Column:
    """Milliseconds of an interval's name; of unknown names, a minute."""
    name = F.col(name) if isinstance(name, str) else name
    held = F.create_map(*(F.lit(x) for pair in INTERVAL_MS.items() for x in pair))
    return F.coalesce(F.try_element_at(held, name), F.lit(UNKNOWN_MS)).cast("long")


def interval_minutes(name: str, unknown: int) -> int:
    return INTERVAL_MS[name] // 60_000 if name in INTERVAL_MS else unknown


def epoch_ns(ts: Column | str) -> Column:
    return F.unix_micros(ts) * 1000


def from_epoch_ns(ns: Column) -> Column:
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))  # whole numbers: doubles can't hold all ns


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)
