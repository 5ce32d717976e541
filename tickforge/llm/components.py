"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


HOT_SHARE = 128


def join_by_count(rows: DataFrame, side: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with side, which has one row a key and, in `members`, how many of the `total` rows have it.

    Keys of more than a share of all rows, which number at most HOT_SHARE, are met by broadcast, so that none's
    rows come into one task.
    """
    many = F.col("members") > max(1, total // HOT_SHARE)
    hot, cold = F.broadcast(side.where(many)), side.where(~many)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, how))


def beside_least(edges: DataFrame, total: int) -> DataFrame:
    """edges (u, v) with the least v of each u, and in members how many u has."""
    return join_by_count(edges, edges.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("members")), "u", total)


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for all nodes of edges (u, v), of any orderable type; root is the component's smallest node.

    Alternates large-star and small-star steps, each of which only moves edges to smaller
    ends, until a round changes nothing: about log(n) rounds, whatever the diameter.  Hot
    nodes are met by partial aggregation and by broadcasts of at most HOT_SHARE rows.
    Nulls and self-loops are dropped; an empty input gives an empty result.
    """
    def signed(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())

    now = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    sign = signed(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = beside_least(both, 2 * sign[0]).where("v > u").select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
        down = stored(large.where("u <> v").distinct(), "edges")
        small = beside_least(down, sign[0]).select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("least").alias("v"))
        now = stored(small.where("u <> v").distinct(), "edges")
        was, sign = sign, signed(now)
        if sign == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
