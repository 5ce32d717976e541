"""Texts and columns that every operator must bear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edge_texts() -> list[str | None]:
    """Null, empty, spaces, ties and repeats, non-ASCII, and a very long text."""
    return [None, "", " \t\n\x0b\x0c\r ", "one", "one", "tie tie tie tie tie tie tie", "é ü 日本 ☃ a b", "# * | <>", "\n\n", ("long words here " * 40_000) + "end"]


def clashing(df: DataFrame, *names: str) -> DataFrame:
    """df with further columns of names that operators use inside."""
    return df.withColumns({n: F.lit("clash") for n in names})
