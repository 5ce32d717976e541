from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from llm_cases import clashing, edge_texts
from pyspark.sql import functions as F

from tickforge.llm import ngram_jaccard as J
from tickforge.llm.components import connected


def brute(rows, threshold=80):
    """{row: (n_shingles, component, links)} from all pairs that share a shingle."""
    from conftest_llm import ASCII_LOWER, words

    sets = []
    for _, text in rows:
        w = words((text or "").translate(ASCII_LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x]).items():
            if 100 * n >= threshold * len(s | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
        for x in s:
            where[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [(d, len(s), least[find(i)], links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def check(df, **how):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sorted((tuple(r) for r in J.similarity_classes(df, **how).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def near(words_, rng, edits):
    w = list(words_)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_smallest_data(spark, tiny):
    check(spark.read.parquet(f"{tiny}/documents.parquet"))


@pytest.mark.parametrize("block", [3, 256])
def test_large_family_in_blocks(documents, block):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    df = documents(*(near(base, rng, rng.randrange(6)) for _ in range(60)), *(near([f"v{k}_{i}" for i in range(90)], rng, 1) for k in range(4) for _ in range(3)))
    check(df, block_docs=block, chunk_bytes=5000, bucket_shingles=500)


@pytest.mark.parametrize("wide", [1, 3, 8])
def test_narrow_and_wide_shingles(documents, wide):
    """Groups of near copies of all sizes, chained ones, and sets of neighbouring size classes in large families."""
    rng = random.Random(wide)
    texts = [near([f"g{g}_{i}" for i in range(40 + 7 * g)], rng, rng.randrange(3)) for g in range(12) for _ in range(1 + g)]
    base = [f"c{i}" for i in range(400)]
    texts += [" ".join(base[k : k + 100 + k % 60]) for k in range(0, 160, 3)]
    check(documents(*texts), wide=wide, block_docs=5, block_shingles=2000, chunk_bytes=4000, bucket_shingles=300)


def test_texts_without_a_common_shingle_never_link(documents):
    """Their shingle hashes agree in the first 32 bits."""
    check(documents("f756f 8811d 4fbf8 5f6f9 26905", "c24b5 8fb93 86eba 393b5 2ea44"))


def test_wide_families_compare_neighbouring_sizes_only(spark):
    family = spark.createDataFrame([(bytes([k, j]), b"r", n) for j in range(40) for k, n in enumerate((10, 12, 100, 124, 1000))], "digest binary, root binary, n int")
    got = J.blocks_of(family, 200, 80, 4, 1 << 20).collect()
    sizes = {bytes(r["digest"]): r["n"] for r in family.collect()}
    met = defaultdict(set)
    for r in got:
        met[r["bi"], r["bj"]].add((bytes(r["digest"]), r["block"]))
    together = {(a, b) for g, rows in met.items() for a, x in rows for b, y in rows if a < b and (g[0] == g[1] or x != y)}
    assert {(a, b) for a in sizes for b in sizes if a < b and 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b])} <= together
    assert not any(max(sizes[a], sizes[b]) > 2 * min(sizes[a], sizes[b]) for a, b in together)


def test_edges(documents):
    check(documents(*edge_texts(), "a b c d", "A B c d", "a b c d e", "A b C d E", (7, "same id " * 9), (7, "same id " * 9), (None, "no id at all here")))


def test_extra_columns_and_empty_table(documents):
    df = clashing(documents("a b c d e f g", "a b c d e f g"), "digest", "component_id", "copies", "chunk", "n_shingles")
    assert [r["component_id"] for r in J.similarity_classes(df).collect()] == [0, 0]
    assert J.similarity_classes(df.limit(0)).count() == 0


def test_one_of_each_keeps_columns(documents):
    df = clashing(documents("a b c d e f g", "A b c d e f g", "other words entirely in this one", None, ""), "component_id")
    kept = J.one_of_each(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4]


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    extra = spark.createDataFrame([(1000, 1001), (1001, 1000), (1002, 1002)], "u long, v long")
    got = {r["node"]: r["root"] for r in connected(edges.unionByName(extra)).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
