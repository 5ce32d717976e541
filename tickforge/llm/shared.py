"""Places and tables that all operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and Spark runs on this machine alone (tests)."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if held:
        return held.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="spark-llm-"))
    return _own[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, and lost executors cost no more than their tasks."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def grown(each: int, total: int, up_to: int) -> int:
    """A part's size for a total: `each` while the total is at most up_to, then growing with its square root.

    Messages from every part of one kind to every part of another then grow with the total, not with its square.
    """
    return int(each * max(1.0, (total or 0) / up_to) ** 0.5)


def tasks(spark: SparkSession, wanted: int) -> int:
    """As many tasks as wanted, at least those that the session shuffles to."""
    return max(int(wanted), int(spark.conf.get("spark.sql.shuffle.partitions")))


def parts(total: int, each: int) -> int:
    """How many parts of about `each` make up `total`; at least 1."""
    return max(1, -(-int(total or 0) // each))
