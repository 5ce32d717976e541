"""Draws documents that resemble a target text collection: importance resampling on hashed n-grams.

A position table has a row for each word of a document (posexplode), beside it the words that
follow it (lead within the document, one for each further order).  Every run of 1 to `orders`
words is a feature and falls into a bucket by its CRC-32.  Buckets are counted over all
documents and over the target; a bucket's gain is the floored 1000-fold logarithm of its
smoothed rate in the target over that in the documents.  A document's weight is the floored
mean gain of its features; Gumbel noise that a hash of doc_id seeds is added, and the highest
sums are drawn, which is a draw without repeats in proportion to exp(weight / 1000).

Scale: texts are shuffled once, by document, before they are exploded, so that windows and
sums need no other exchange of words; the position table is written once, with bucket numbers
in place of words, and read for the counts and for the gains.  Rows with equal id and text
are one unit with a number of copies (keys of more than a share of all rows are merged before
the shuffle).  Gains are a row a bucket, which bounds their broadcast.  Ranks come from a
range partitioning by score and the sizes of its parts, not from one sorted task.  All is
built of SQL functions.

Null and empty texts, and those without words, have no features and weight 0; a null doc_id is
written as the empty text for its hash.  Documents of fewer than `least_words` words have a
score but are never drawn.  Equal scores go to the smaller doc_id, null last, then by a hash
of the text; equal rows take neighbouring ranks.  Very long texts are spread over rows of
the position table.  Further columns are not looked at.  An empty table gives no rows; an
empty target counts nothing, so every bucket's gain follows from the documents alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import HOT_SHARE
from .shared import parts, stored, table, tasks, text_bytes

ORDERS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
TASK_BYTES = 16 << 20  # of text, in a task of the position table
RANK_ROWS = 2 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN_CHARS = "".join(chr(c) for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A))


def _units(docs: DataFrame) -> DataFrame:
    """(doc_id, k: of the text's hash, text, copies), dealt to tasks by (doc_id, k), one row each."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.select("doc_id", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long").alias("k"), "text")
    size = docs.agg(F.sum(text_bytes()).alias("bytes"), F.count("*").alias("rows")).first()
    most = max(1, size["rows"] // HOT_SHARE)
    hot = F.broadcast(own.groupBy("doc_id", "k").agg(F.count("*").alias("n")).where(F.col("n") > most).select("doc_id", "k"))  # fewer than HOT_SHARE rows, or a table of few rows
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("doc_id", "k")]
    cold = own.alias("o").join(hot.alias("h"), same, "left_anti").select("doc_id", "k", "text", F.lit(1).cast("long").alias("copies"))
    merged = own.alias("o").join(hot.alias("h"), same, "left_semi").groupBy("doc_id", "k").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    dealt = cold.unionByName(merged).repartition(tasks(spark, parts(size["bytes"], TASK_BYTES)), "doc_id", "k")
    return dealt.groupBy("doc_id", "k").agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def position_table(docs: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """A row for each word of each (doc_id, k, copies): in b1, b2, ... the buckets of the runs of words that start there.

    A document without words has one row of nulls.
    """
    lowered = F.btrim(F.translate("text", UPPER, LOWER), F.lit(_BETWEEN_CHARS))
    words = _units(docs).select("doc_id", "k", "copies", F.posexplode(F.split(lowered, BETWEEN)).alias("pos", "word"))
    along = Window.partitionBy("doc_id", "k").orderBy("pos")
    follow = words.select("*", *(F.lead("word", i).over(along).alias(f"w{i}") for i in range(1, orders)))
    runs = [F.concat(*(x for i in range(order) for x in ((F.lit(" "),) if i else ()) + (F.col(f"w{i}" if i else "word"),))) for order in range(1, orders + 1)]
    return follow.select("doc_id", "k", "copies", *(F.when(F.col("word") != "", _bucket(run, buckets)).alias(f"b{i + 1}") for i, run in enumerate(runs)))


def _counts(positions: DataFrame, name: str, orders: int) -> DataFrame:
    """(bucket, name) of the buckets that have features."""
    each = [positions.where(F.col(f"b{i}").isNotNull()).groupBy(F.col(f"b{i}").alias("bucket")).agg(F.sum("copies").alias(name)) for i in range(1, orders + 1)]
    both = each[0]
    for more in each[1:]:
        both = both.unionByName(more)
    return both.groupBy("bucket").agg(F.sum(name).alias(name))


def bucket_gains(positions: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket."""
    spark = positions.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    held = every.join(_counts(positions, "s", orders), "bucket", "left").join(_counts(target, "t", orders), "bucket", "left").select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")))
    held = stored(held, "bucket-counts")
    total = held.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(float(total["s"] + buckets))) / ((F.col("s") + 1) * F.lit(float(total["t"] + buckets)))
    return held.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _ranked(scored: DataFrame, take: int) -> DataFrame:
    """scored with rank: 1 to take by score, in units' copies; null beyond.  Parts of a range partitioning are counted first."""
    n = tasks(scored.sparkSession, parts(take, RANK_ROWS))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("k").asc()]
    dealt = stored(scored.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "ranked")
    before = dealt.groupBy("part").agg(F.sum("copies").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a task
    within = F.sum("copies").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(before), "part").withColumn("last", F.col("before") + within)


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, orders: int = ORDERS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs (doc_id, text); target has (text) and any ids."""
    positions = stored(position_table(docs, orders, buckets), "positions")
    target_rows = target.select(F.lit(0).cast("long").alias("doc_id"), "text")  # rows are told apart by their texts
    gains = F.broadcast(stored(bucket_gains(positions, position_table(target_rows, orders, buckets), orders, buckets), "gains"))  # a row a bucket
    met = positions
    for i in range(1, orders + 1):
        met = met.join(gains.select(F.col("bucket").alias(f"b{i}"), F.col("gain").alias(f"g{i}")), f"b{i}", "left")
    total = sum((F.coalesce(f"g{i}", F.lit(0)) for i in range(2, orders + 1)), F.coalesce("g1", F.lit(0)))
    number = sum((F.col(f"b{i}").isNotNull().cast("long") for i in range(2, orders + 1)), F.col("b1").isNotNull().cast("long"))
    summed = met.groupBy("doc_id", "k", "copies").agg(F.sum(number).alias("n_features"), F.count("b1").alias("n_words"), F.sum(total).alias("total"))
    seen = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((seen + 0.5) / 4294967296.0)))
    weighed = summed.withColumn("weight", F.when(F.col("n_features") > 0, F.floor(F.col("total") / F.col("n_features"))).otherwise(0).cast("long")).withColumn("score", F.col("weight") + noise)
    weighed = stored(weighed.select("doc_id", "k", "copies", "n_features", "n_words", "weight", "score"), "weighed")
    able = F.col("n_words") >= least_words
    take = int(weighed.where(able).agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]) * percent // 100
    ranked = _ranked(weighed.where(able), take).unionByName(weighed.where(~able), allowMissingColumns=True)
    each = ranked.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rank = F.col("last") - F.col("copies") + F.col("copy")
    return each.select("doc_id", "n_features", "weight", "score", F.when(rank <= take, rank).alias("rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: CRC-32 byte by byte, over each different feature once.
SQL = rf"""WITH slots AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS slot FROM range(256) r(n)),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM benchmark),
df AS (SELECT row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM d),
bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM b),
hexed AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM (SELECT feature FROM df UNION ALL SELECT feature FROM bf)),
codes AS (
  SELECT feature, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1),
                                  lambda c, x: xor(c // 256, slot[xor(c % 256, x) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket
  FROM hexed, slots),
s AS (SELECT bucket, count(*) AS s FROM df JOIN codes USING (feature) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN codes USING (feature) GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT count(*) FROM df)::DOUBLE + {BUCKETS}) / ((s::DOUBLE + 1) * ((SELECT count(*) FROM bf)::DOUBLE + {BUCKETS}))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN codes USING (feature) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
  SELECT row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= {LEAST_WORDS} AS able,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (row)),
placed AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE able)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= (SELECT count(*) * {PERCENT} // 100 FROM placed) THEN place END AS rank FROM scored LEFT JOIN placed USING (row)"""
