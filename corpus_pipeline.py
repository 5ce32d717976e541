"""A corpus from documents to token ids: reject, deduplicate, decontaminate, mix, encode.

Each stage works on all that its predecessor kept.  A stage's rows are written as Parquet in
the folder that the cluster shares, and read again as the next one's documents.

Null and empty texts are never toxic and have no shingles and no benchmark words: they go
through the filters.  As their size is 0, the mix repeats them as their source's rate says,
and their ids are the end id alone.  Rows of a null id are documents like others; of rows
with equal id and text one stays after the second stage, as of all rows of one class, and of
a class the smallest id stays (null before all).  Very long texts are worked through whole in
every stage.  Equal evidence at the threshold of toxicity rejects.  Further columns of
documents are kept up to the last stage, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import decontaminate, mixing, ngram_jaccard, ordinal_toxicity, repair_ids
from tickforge.llm.shared import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return ordinal_toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repair_ids.encode_documents(docs, added_tokens=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", encode_ids),
]

#: Token ids of a byte-level vocabulary and a fitted model can't be had in SQL; tests compare stage by stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
