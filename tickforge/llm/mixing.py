"""Mixing sources to target weights by hash-seeded repetition.

The size of a document is its number of words; sizes are added up per source.  Sources in
order (code points, null last) get the weights in turn; targets share `share` times all
sizes by weight, stop at `cap` times their source's size, and the excess is shared again by
weight until none is above.  The repetition rate of a source is target / size.  A document
is emitted floor(rate) times, and once more with probability rate - floor(rate): a
Bernoulli draw from a hash of its id and a seed.  Of `seeds` seeds, a source uses the one
whose draws come nearest its target (one aggregation over ids and sizes, no sampling).

Scale: texts are read once for sizes, which are kept as a slim table; all sums are
aggregated before they are shuffled, so a source with a third of all rows is a few partial
sums.  Only the table of sources, one row each, is ordered as a whole, in one task: sources
are taken to be sites or collections, of which a task can sort millions.  It is joined back to
documents under Spark's own size check for broadcasts, else by a join that may be split.

Null texts and texts without words have size 0; a very long text is counted whole; rates of sources of size 0 are 0.  Null is a
source.  Repeated ids draw alike.  An empty table gives no rows.  Columns of the input keep
their names, whatever they are: the plan's columns carry a prefix that none of them has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stored, table

WEIGHTS, SHARE, CAP, SEEDS = (5.0, 2.0, 1.0), 1.5, 2.0, 16
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _chance(seed: Column | int, id_col: str) -> Column:
    """A number in [0, 1) from a hash of the seed and the id."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.shiftrightunsigned(F.xxhash64(seed.cast("int"), F.col(id_col)), 11) / F.lit(float(1 << 53))


def _copies(rate: Column, seed: Column | int, id_col: str) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(_chance(seed, id_col) < rate - whole, 1).otherwise(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, rate) of every source of sizes (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))).withColumn("most", cap * F.col("source_size"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum(share * F.col("source_size")).over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = weighed.withColumn("level", level).withColumn("free", F.when(F.col("level") < F.col("most") / F.col("weight"), F.row_number().over(fill)))
    filled = filled.withColumn("place", F.row_number().over(fill)).withColumn("first_free", F.min("free").over(everything))
    settled = F.max(F.when(F.col("place") == F.col("first_free"), F.col("level"))).over(everything)
    target = F.when(F.col("place") < F.coalesce("first_free", F.lit(1 << 62)), F.col("most")).otherwise(settled * F.col("weight"))
    return filled.withColumn("target", target).select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def mixing_plan(sizes: DataFrame, seeds: int = SEEDS, **how) -> DataFrame:
    """(source, source_size, target, rate, seed) of every source of sizes (doc_id, source, size)."""
    targets = stored(source_targets(sizes, **how), "targets").withColumnRenamed("source", "of")
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["of"]))
    taken = joined.groupBy("source").agg(F.first("target").alias("target"), *(F.sum(F.col("size") * _copies(F.col("rate"), s, "doc_id")).alias(f"taken_{s}") for s in range(seeds)))
    misses = F.array(*(F.struct(F.abs(F.col(f"taken_{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed")) for s in range(seeds)))
    best = taken.select("source", F.array_min(misses)["seed"].alias("seed"))
    return stored(best.join(targets, best["source"].eqNullSafe(targets["of"])).select("source", "source_size", "target", "rate", "seed"), "mixing-plan")


def doc_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size_of(text_col).alias("size")), "sizes")


def with_copies(rows: DataFrame, plan: DataFrame, id_col: str = "doc_id", source_col: str = "source", prefix: str = "mix_") -> DataFrame:
    """All columns of rows, those of the plan with the prefix, and copies with it; rows must have no columns of such names."""
    own = plan.select(*(F.col(c).alias(prefix + c) for c in plan.columns))
    joined = rows.join(own, rows[source_col].cast("string").eqNullSafe(own[f"{prefix}source"])).drop(f"{prefix}source")
    return joined.withColumn(f"{prefix}copies", _copies(F.col(f"{prefix}rate"), F.col(f"{prefix}seed"), id_col))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    prefix = "mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    plan = mixing_plan(doc_sizes(docs, id_col, text_col, source_col), **how)
    counted = with_copies(docs, plan, id_col, source_col, prefix).where(F.col(f"{prefix}copies") > 0)
    return counted.withColumn(f"{prefix}copy", F.explode(F.sequence(F.lit(1).cast("long"), f"{prefix}copies"))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = doc_sizes(table(spark, sf_dir, "documents"))
    counted = with_copies(sizes, mixing_plan(sizes))
    return counted.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("size") * F.col("mix_copies")).alias("taken"))
