from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import ASCII_LOWER, prose
from llm_cases import clashing, edge_texts
from rows import same_rows

from tickforge.llm import importance_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, orders=2):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % R.BUCKETS for n in range(1, orders + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=R.PERCENT, least_words=R.LEAST_WORDS, orders=2):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text, orders)[1])
    for text in target:
        t.update(features(text, orders)[1])
    n, m = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n + R.BUCKETS) / ((s[b] + 1) * (m + R.BUCKETS)))) for b in s}
    out = []
    for doc_id, text in rows:
        words, found = features(text, orders)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{R.SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least_words, None])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted((tuple(r[:4]) + (r[5],) for r in out), key=str)


def check(spark, df, target, **how):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = R.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target, **how)


def test_query_equals_sql_and_brute_force(spark, tiny, duck):
    got = R.query(spark, tiny).toPandas()
    same_rows(got, duck.sql(R.SQL).df())
    docs, target = (spark.read.parquet(f"{tiny}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert sorted((tuple(None if v != v else int(v) for v in r) for r in got.itertuples(index=False)), key=str) == want


def test_edges(spark, documents):
    texts = [*edge_texts(), "\x00A\x7fb\x80c Ünï ÀB", "Zz" * 300, *(prose(30, k, 40) for k in range(40))]
    check(spark, documents(*texts), ["", None, prose(100, 3, 40), "w1 w2"], percent=60)


@pytest.mark.parametrize("orders", [1, 3])
def test_other_orders(spark, documents, orders):
    check(spark, documents(*(prose(25, k, 30) for k in range(20)), "one", "one two"), [prose(60, 5, 30)], orders=orders, least_words=2)


def test_repeated_rows_and_ids(spark, documents):
    """Rows that are equal, a third of all and more, are all there and take neighbouring ranks; ids that repeat with other texts and null ids stay apart."""
    hot = [(5, prose(30, 1, 20), "s")] * 300
    df = documents(*hot, *((None, None, "s") for _ in range(200)), *((9, prose(25, k, 20), "s") for k in range(10)), *((None, prose(25, k, 20), "s") for k in range(3)), *((100 + k, prose(22, k, 20), "s") for k in range(50)))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    target = [prose(60, 7, 20)]
    got = R.resampled(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    want = brute(rows, target)
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted((r[:4] for r in want), key=str)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + sum(len(WORD.findall(t or "")) >= 20 for _, t in rows) // 4))
    by_rank = sorted((r["rank"], -r["score"]) for r in got if r["rank"])
    assert [s for _, s in by_rank] == sorted(s for _, s in by_rank)


def test_extra_columns_and_empty_tables(spark, documents):
    df = clashing(documents(prose(30, 1), prose(30, 2), None), "k", "pos", "word", "copies", "b1", "part", "rank", "gain")
    target = spark.createDataFrame([(None,)], "text string")
    check(spark, df, [None])
    assert R.resampled(df.where("false"), target).count() == 0
    assert R.resampled(df, target.where("false")).count() == 3
