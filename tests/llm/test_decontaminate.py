from __future__ import annotations

import random

from conftest_llm import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing, edge_texts
from rows import same_rows

from tickforge.llm import decontaminate as D

ITEMS = "item_id long, text string"


def test_smallest_data_equals_sql(spark, tiny, duck):
    same_rows(D.query(spark, tiny).toPandas(), duck.sql(D.SQL).df())


def test_parts_edges_and_sql(spark, documents):
    import duckdb

    rng = random.Random(3)
    items = [(k, prose(rng.randrange(1, 30), k, 30)) for k in range(30)] + [(40, None), (41, ""), (42, "..."), (43, "One"), (1, prose(12, 99, 30)), (None, "tie tie tie")]
    df = documents(*(t for t in edge_texts() if t is None or len(t) < 1000), *(prose(rng.randrange(60), 500 + k, 30) for k in range(30)), items[3][1].upper(), (3, "x"), (3, "ONE-one"), (None, items[9][1]))
    bench = spark.createDataFrame(items, ITEMS)
    held = duckdb.connect()
    frames = {"documents": df.toPandas(), "benchmark": bench.where("item_id is not null").toPandas()}
    for name, frame in frames.items():
        held.register(name, frame)
    held.sql("CREATE VIEW b2 AS SELECT item_id::BIGINT AS item_id, text FROM benchmark")
    want = held.sql(D.SQL.replace("FROM benchmark", "FROM b2")).df()
    bench = bench.where("item_id is not null")
    keyed = lambda x: x.drop(columns="doc_id")  # noqa: E731  (ids repeat, and SQL joins by them)
    one = D.with_digests(D.find_benchmark(df.where("doc_id <> 3 and doc_id is not null"), bench)).toPandas()
    many = D.with_digests(D.find_benchmark(df.where("doc_id <> 3 and doc_id is not null"), bench, part_bytes=200)).toPandas()
    same_rows(one, many)
    same_rows(keyed(one), keyed(want[want["doc_id"].notna() & (want["doc_id"] != 3)]))
    assert D.with_digests(D.find_benchmark(df, bench)).where("doc_id is null or doc_id = 3").where("contaminated").count() >= 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ", min_size=3, max_size=40), min_size=1, max_size=8, unique=True), st.text(alphabet="ab ", max_size=300))
def test_search_finds_every_occurrence(strings, text):
    got = sorted((p, t.strings[i]) for t in D.searchers([s.encode() for s in strings]) for p, i in t.search(text.encode()))
    assert got == sorted((p, s.encode()) for s in strings for p in range(len(text)) if text.startswith(s, p))


def test_very_long_text(documents, spark):
    got = D.with_digests(D.find_benchmark(documents(edge_texts()[-1]), spark.createDataFrame([(1, "words here end")], ITEMS))).first()
    assert (got["n_words"], got["n_hit"], got["n_items"]) == (120_001, 3, 1)


def test_filter_keeps_columns_and_empty_tables(spark, documents):
    df = clashing(documents("one two three", "four"), "hits", "items", "n_words")
    bench = spark.createDataFrame([(1, "TWO three"), (2, None)], ITEMS)
    kept = D.without_contaminated(df, bench)
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert D.without_contaminated(df, bench.limit(0)).count() == 2 and D.find_benchmark(df.limit(0), bench).count() == 0
    assert [r["contaminated"] for r in D.with_digests(D.find_benchmark(df, bench.limit(0))).collect()] == [False, False]
