from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing, edge_texts
from tokenizers import Tokenizer

from tickforge.llm import files
from tickforge.llm import repair_ids as I
from tickforge.llm.kernel import byte_view
from tickforge.llm.shared import fresh_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(I.default_tokenizer())


def check(df, tokenizer):
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for d, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, I.END_ID]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in I.encode_documents(df).collect()), key=lambda r: r[1])
    assert got == want


def test_smallest_data(spark, tiny, tokenizer):
    check(spark.read.parquet(f"{tiny}/documents.parquet"), tokenizer)


def test_edges(documents, tokenizer):
    check(documents(*edge_texts(), "a#b ## #", "<|endoftext|> it's don't I'LL x's", (7, "x"), (7, "y"), (7, None), (None, "z")), tokenizer)


def test_extra_columns_and_empty_table(documents, tokenizer):
    df = clashing(documents("a b", "c"), "start", "ids", "uri", "part", "number", "before")
    check(df, tokenizer)
    assert I.encode_documents(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z9'.,-\n\t  　é日_#"), max_size=40), min_size=1, max_size=6))
def test_pieces_equal_whole_texts(texts):
    pieces = I._pieces(I.default_tokenizer())
    data, offsets = byte_view(pa.array(texts, pa.string()))
    ids, counts = pieces.encode(data, offsets)
    want = [pieces.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, 7]), max_size=60), min_size=1, max_size=8))
def test_shards_decode_whole_and_by_document(docs):
    docs = [[*d, 2] for d in docs]
    ids = np.array([i for d in docs for i in d], np.uint32)
    shard = I.Shard(I.shard_bytes([None, *range(1, len(docs))], np.array(list(map(len, docs))), ids, 2, 100, least=2))
    assert shard.all_ids().tolist() == ids.tolist() and shard.doc_ids == [None, *range(1, len(docs))]
    assert [shard.document(k).tolist() for k in range(len(docs))] == docs
    framed = I.Shard(I.shard_bytes([None, *range(1, len(docs))], np.array(list(map(len, docs))), ids, 2, 100, frame=3, least=2))
    assert framed.all_ids().tolist() == ids.tolist() and [framed.document(k).tolist() for k in range(len(docs))] == docs
    for a, b in ((0, len(ids)), (1, 5), (len(ids) // 2, len(ids) - 1), (3, 3)):
        assert framed.span(a, b).tolist() == ids[a:b].tolist()
    seq, rules, rounds = I.re_pair(ids, 2, 100, least=2)
    pairs = [p for p in zip(seq.tolist(), seq.tolist()[1:]) if 2 not in p]
    apart = {p: 0 for p in pairs}
    last = {}
    for k, p in enumerate(zip(seq.tolist(), seq.tolist()[1:])):
        if p in apart and last.get(p) != k - 1:
            apart[p], last[p] = apart[p] + 1, k
    assert max(apart.values(), default=0) < 2 and rounds.sum() == len(rules)  # no pair is left twice, but where it overlaps itself


def test_document_reads_its_own_frames(tmp_path):
    rng = np.random.default_rng(0)
    docs = [np.append(rng.integers(3, 60_000, 3000), 2) for _ in range(200)]
    data = I.shard_bytes(list(range(200)), np.array([len(d) for d in docs]), np.concatenate(docs).astype(np.uint32), 2, 65_000)
    uri = f"file://{tmp_path}/a.rpt"
    files.put(uri, data)
    shard, read = I.Shard(uri), []
    inner = shard._read
    shard._read = lambda at, n: read.append(n) or inner(at, n)
    assert shard.document(150).tolist() == docs[150].tolist() and sum(read) < len(data) / 20


def test_grammar_compresses_and_spares_ends():
    ids = np.array(([5, 6, 7, 8] * 50 + [2]) * 20, np.uint32)
    seq, rules, _ = I.re_pair(ids, 2, 100, least=4)
    assert len(seq) < len(ids) / 4 and not (rules == 2).any() and (seq == 2).sum() == 20


def test_stretches_of_one_id_take_few_rounds():
    ids = np.append(np.full(100_000, 7), 2).astype(np.uint32)
    seq, rules, rounds = I.re_pair(ids, 2, 100)
    lengths = I.rule_lengths(rules, rounds, 100)
    assert len(rounds) < 40 and len(seq) < 100 and I.expand(seq, rules, rounds, lengths, 100).tolist() == ids.tolist()


def test_files_of_lost_attempts_are_not_read(spark, documents, tokenizer):
    path = fresh_path(spark, "ids")
    shards = I.write_shards(documents(*(prose(40, k) for k in range(6))), path, shard_ids=50)
    files.put(f"{path}/ids-000000-00000-lost.rpt", b"half a file")
    got = {r["doc_id"]: [x & 0xFFFFFFFF for x in r["ids"]] for r in I.read_shards(shards).collect()}
    assert got == {k: [*tokenizer.encode(prose(40, k), add_special_tokens=False).ids, 2] for k in range(6)}


def test_long_stretches_without_cuts(documents, tokenizer):
    cjk, numbers = "日本語の文章は空白を含まない。" * 6_667, "\n".join(str(k * 7919 % 100_003) for k in range(100_000))
    check(documents(cjk, "short", numbers, "字" * 100_000, cjk + "x", None, numbers.replace("\n", "\t"), cjk), tokenizer)
    pieces = I.Pieces(I.default_tokenizer())
    data, offsets = byte_view(pa.array([cjk, numbers, "a b", cjk], pa.string()))
    for _ in range(2):
        assert pieces.encode(data, offsets)[1].tolist() == [len(tokenizer.encode(t).ids) for t in (cjk, numbers, "a b", cjk)]
    assert pieces.ids.n < 10  # long pieces are not held


def test_queries_give_ids_of_an_untouched_tokenizer(spark, documents, monkeypatch):
    import corpus_pipeline

    untouched, end = Tokenizer.from_file(I.default_tokenizer()), "<|endoftext|>"
    texts = [f"a {end} b", f"{end}{end}  x  {end}", end, f"a{end}b. {end}", "<|endof", f"text|> {end}", "a#b <|endoftext |>", f"\n {end}\u3000 x", f"é{end}<|{end}|>", "c"]
    df = documents(*texts)
    monkeypatch.setattr(I, "table", lambda *_: df)
    for found in (I.query(spark, ""), corpus_pipeline.encode_ids(spark, df, "")):
        check_rows = [(r["n_tokens"], r["ids_crc32"]) for r in found.orderBy("start").collect()]
        want = [[*untouched.encode(t, add_special_tokens=False).ids, I.END_ID] for t in texts]
        assert check_rows == [(len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for w in want]


def test_memory_of_a_worker_is_small():
    """What a worker takes for a shard and its texts: two of them, and their JVM, are an executor."""
    import tracemalloc

    from tickforge.llm.kernel import slices

    rng = np.random.default_rng(4)
    data, offsets = byte_view(pa.array([" ".join(f"{a}{b}" for a, b in zip(map("".join, rng.choice([*"abcdefgh"], (200, 4))), rng.choice(["ing", "s", ""], 200))) for _ in range(3000)], pa.string()))
    pieces, most = I.Pieces(I.default_tokenizer()), getattr(I, "ENCODE_BYTES", 1 << 20)
    ids = np.append(rng.integers(3, 2000, I.SHARD_IDS - 1), 2).astype(np.uint32)
    tracemalloc.start()
    try:
        for lo, hi in slices(offsets, most):
            pieces.encode(data, offsets[lo : hi + 1])
        encoding = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        I.re_pair(ids, 2, 65_000)
        pairing = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    held = (pieces.held.bytes, pieces.held.starts, pieces.held.sizes, pieces.ids, pieces.starts, pieces.sizes)
    assert encoding < 32 << 20 and pairing < 48 << 20 and sum(x.data.nbytes for x in held) < 44 * len(pieces.held)
