"""Windows over one symbol and interval by time, with strict warm-up.

All finite indicators use the one partitioning (symbol, interval) and order (timestamp), so
any number of them costs one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schema import KEY


def series() -> WindowSpec:
    return Window.partitionBy(*KEY).orderBy("timestamp")


def last_rows(n: int) -> WindowSpec:
    return series().rowsBetween(1 - n, 0)


def strict(agg: Callable[[Column], Column], x: Column, n: int) -> Column:
    """agg over the last n rows; NULL unless all n have a value."""
    return F.when(F.count(x).over(last_rows(n)) == n, agg(x).over(last_rows(n)))


def mean(x: Column, n: int) -> Column:
    return strict(F.avg, x, n)


def deviation(x: Column, n: int) -> Column:
    """Population deviation."""
    return strict(F.stddev_pop, x, n)


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is above 0, else NULL."""
    return F.when(b > 0, a / b)
