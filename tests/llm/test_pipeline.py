"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_jaccard import brute

from tickforge.llm import decontaminate, mixing, ordinal_toxicity
from tickforge.llm.shared import stored, table


def rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages(spark, tiny):
    docs = table(spark, tiny, "documents")
    columns, inputs, outputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = outputs[name] = stored(stage(spark, docs, tiny), "test")
        assert name == "token_ids" or docs.columns == columns
    toxic = {r["doc_id"] for r in ordinal_toxicity.graded(inputs["toxicity"], ordinal_toxicity.learn(inputs["toxicity"], table(spark, tiny, "labels"))).where("toxic").collect()}
    assert toxic and rows(outputs["toxicity"]) == Counter({k: n for k, n in rows(inputs["toxicity"]).items() if k[0] not in toxic})
    held = list(rows(inputs["ngram_jaccard"]))
    assert set(rows(outputs["ngram_jaccard"])) == {h for h, b in zip(held, brute(held)) if b[0] == b[2]}
    hit = {r["doc_id"] for r in decontaminate.with_digests(decontaminate.find_benchmark(inputs["decontamination"], table(spark, tiny, "benchmark"))).where("contaminated").collect()}
    assert hit and rows(outputs["decontamination"]) == Counter({k: n for k, n in rows(inputs["decontamination"]).items() if k[0] not in hit})
    sizes = mixing.doc_sizes(inputs["mixing"])
    copies = {r["doc_id"]: r["mix_copies"] for r in mixing.with_copies(sizes, mixing.mixing_plan(sizes)).collect()}
    assert rows(outputs["mixing"]) == Counter({k: copies[k[0]] for k in rows(inputs["mixing"]) if copies[k[0]]})
    ids = outputs["token_ids"].orderBy("start").collect()
    assert Counter(r["doc_id"] for r in ids) == Counter(k[0] for k in rows(inputs["token_ids"]).elements())
    assert [r["start"] for r in ids] == [sum(x["n_tokens"] for x in ids[:k]) for k in range(len(ids))]


def test_edges_of_the_pipeline(spark, documents, tmp_path):
    """Nulls, repeats, long texts, clashing names and empty tables, from end to end."""
    from conftest_llm import prose
    from llm_cases import clashing, edge_texts

    item = prose(14, 77)
    rows = [*edge_texts(), (None, prose(30, 1)), (50, prose(30, 2)), (50, prose(30, 2)), (51, prose(30, 2) + " x"), (52, f"{prose(30, 3)} {item} {prose(9, 4)}"), (53, prose(30, 5), None), *(prose(40, 100 + k) + (" vile" if k % 2 else "") for k in range(60))]
    docs = clashing(documents(*rows), "digest", "mix_rate", "hits", "severity", "words", "ell", "part")
    first = docs.where("text like '%vile%'").agg({"doc_id": "min"}).first()[0]
    labels = spark.createDataFrame([(first - 1 + k, 1, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"file://{tmp_path}/{name}.parquet")
    now = table(spark, f"file://{tmp_path}", "documents")
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, f"file://{tmp_path}"), "test")
        assert name == "token_ids" or now.columns == docs.columns
        if name == "decontamination":
            kept = [(r["doc_id"], r["text"]) for r in now.collect()]
    texts = [t for _, t in kept]
    assert not any(t and ("vile" in t or item in t) for t in texts) and texts.count(prose(30, 2)) == 1 and prose(30, 2) + " x" not in texts
    assert (None, prose(30, 1)) in kept and (53, prose(30, 5)) in kept and None in texts and "" in texts and edge_texts()[-1] in texts
    assert {r["doc_id"] for r in now.collect()} <= {d for d, _ in kept}
    for name in ("documents", "labels", "benchmark"):
        table(spark, f"file://{tmp_path}", name).limit(0).write.parquet(f"file://{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0


def test_run_is_registered(spark, tiny):
    import __spark_entry__

    got = __spark_entry__.queries()["pipeline"](spark, tiny)
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100
