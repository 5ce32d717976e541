from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing, edge_texts
from pyspark.sql import functions as F

from tickforge.llm import kernel
from tickforge.llm import piece_ids as P


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.default_model())


def brute(rows, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    return sorted(out, key=str)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check(df, library, **how):
    got = P.decoded(P.encoded(df, **how)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(((r["doc_id"], len(r["ids"]), sha(",".join(map(str, r["ids"]))), sha(r["text"])) for r in got), key=str) == brute(rows_of(df), library)


def test_query_equals_the_library(spark, tiny, library):
    got = P.query(spark, tiny)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows_of(spark.read.parquet(f"{tiny}/documents.parquet")), library)


TEXTS = ["a ", " a", "  a  b   ", "▁a ▁b", "▁", " ▁", "▁ ", "a▁", "a▁ b", "a\n b\t c", "ünï 日本語 ☃ \U0001f600", "\x00 \x00", "<s> </s> <unk> <0x41>", "x" * 5000, " " * 3000, "▁" * 50]


def test_edges_in_small_chunks(documents, library):
    check(documents(*edge_texts(), *TEXTS, (None, "of no id", "s"), (7, "same id", "s"), (7, "same id", "s")), library, chunk_bytes=64, bucket_bytes=20_000)


def test_extra_columns_and_empty_table(documents, library):
    df = clashing(documents("some text", None), "chunk", "bucket", "words", "ids", "counts", "positions", "uri")
    check(df, library)
    assert P.encoded(df.where("false")).count() == 0
    assert P.encoded(documents(None, "")).where(F.size("ids") > 0).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab ▁\n\té日,.x"), max_size=24), max_size=6))
def test_words_make_the_text(texts):
    """Marked words, each segmented alone, give the ids of the whole text."""
    held = P.processor(P.default_model())
    data, offsets = kernel.byte_view(pa.array(texts, pa.string()))
    starts, ends, counts = P.marked_words(data, offsets)
    each = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    ids = [held.encode(w) if w else [held.piece_to_id(P.MARK)] for w in each]
    at = np.append(0, np.cumsum(counts))
    for k, text in enumerate(texts):
        assert sum(ids[at[k] : at[k + 1]], []) == held.encode(text)


def test_words_of_equal_hash_stay_apart(monkeypatch, library, tmp_path):
    """Chunks and tables whose hashes are all the same for a length."""
    monkeypatch.setattr(kernel, "span_hashes", lambda data, starts, ends, codes=None, block=0: (ends - starts).astype(np.uint64))
    texts = ["abc abd abe", "abd abc xyz abc", "xyz", "", "abe abe"]
    chunk = P._Chunk()
    data, offsets = kernel.byte_view(pa.array(texts))
    for k in range(len(texts)):
        chunk.add([k], data, offsets[k : k + 2])
    held = [chunk.words.bytes.data[a : a + n].tobytes().decode() for a, n in zip(chunk.words.starts.data[: len(chunk.words)], chunk.words.sizes.data)]
    assert [" ".join(held[p] for p in at) for *_, at in chunk.slices] == texts
    rows = pa.Table.from_batches(chunk.rows(2, f"file://{tmp_path}"))

    class Words:
        def mapInArrow(self, run, _):
            return pa.Table.from_batches(run(rows.filter(rows.column("bucket").is_valid()).to_batches()))

    got = P._joined(rows.filter(rows.column("uri").is_valid()), P.segmented(Words(), P.default_model()))
    assert got.column("ids").to_pylist() == library.encode(texts)


def test_models_that_cross_markers_are_refused(monkeypatch, tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(open(P.default_model(), "rb").read())
    proto.pieces[500].piece = "a▁b"
    path = tmp_path / "crossing.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        P.processor(str(path))
