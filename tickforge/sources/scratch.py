"""Scratch places in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; where that is unset and Spark runs on this machine alone (tests), under a folder of our own."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-ticks-"))
        held = _own[0]
    return f"{held.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df as rows on shared storage, so that what it was read from may be replaced."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
