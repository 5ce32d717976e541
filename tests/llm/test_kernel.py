"""Hashes of spans, shingles of tiny tables, and spans that are held with their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ASCII_LOWER, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tickforge.llm import kernel as K
from tickforge.llm import ngram_jaccard, ordinal_toxicity, repair_ids, viterbi_counts


def alternating(a: str, b: str, n: int = 2048) -> str:
    """Letters by the parity of the ones in their place's number: sums of any odd base's powers modulo 2**64 can't tell it from its complement."""
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


def shingles(text: str | None) -> set:
    w = words((text or "").translate(ASCII_LOWER))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n", max_size=14)), max_size=5))
def test_shingles_of_tiny_tables(texts):
    data, offsets = K.byte_view(pa.array(texts, pa.string()))
    hashes, doc = K.shingle_sets(data, offsets)
    want = [shingles(t) for t in texts]
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(s) for s in want]
    held: dict = {}
    for k, s in enumerate(want):
        got = hashes[doc == k]
        for other, other_set in held.values():
            assert len(np.intersect1d(got, other)) == len(s & other_set)
        held[k] = got, s


@pytest.mark.parametrize("n", (0, 1, 2, 3, 6))
def test_tables_of_few_words(documents, n):
    df = documents(*([" ".join("abcdefg"[:n])] * 2))
    got = sorted(tuple(r) for r in ngram_jaccard.similarity_classes(df).select("n_shingles", "component_id", "n_links").collect())
    assert got == ([(max(1, n - 4), 0, 1)] * 2 if n else [(0, 0, 0), (0, 1, 0)])


def test_learning_from_two_words(spark, documents):
    df = documents("vile text", "")
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert ordinal_toxicity.graded(df, ordinal_toxicity.learn(df, labels)).count() == 2


def test_no_pattern_shares_a_hash():
    texts = [alternating("a", "b", n)[k:] for n in (1024, 4096) for k in (0, 1)] + [alternating("b", "a", n)[k:] for n in (1024, 4096) for k in (0, 1)]
    data, offsets = K.byte_view(pa.array(texts))
    assert len(set(K.span_hashes(data, offsets[:-1], offsets[1:]).tolist())) == len(texts)


def test_alternating_words_do_not_link(documents):
    df = documents(alternating("a", "b"), alternating("b", "a"))
    assert [tuple(r) for r in ngram_jaccard.similarity_classes(df).select("component_id", "n_links").orderBy("component_id").collect()] == [(0, 0), (1, 0)]


@pytest.fixture
def clashing_hashes(monkeypatch):
    """All spans of one length have one hash, so that only their bytes tell them apart."""
    monkeypatch.setattr(K, "span_hashes", lambda data, starts, ends, codes=None, block=0: (ends - starts).astype(np.uint64))


TEXTS = ["abc abd abe abc xyz", "abd abc", alternating("t", "h", 1024), alternating("h", "t", 1024), "", "abe", "ab ab ba ba"]


def test_ids_where_hashes_clash(clashing_hashes):
    from tokenizers import Tokenizer

    pieces, library = repair_ids.Pieces(repair_ids.default_tokenizer()), Tokenizer.from_file(repair_ids.default_tokenizer())
    for texts in (TEXTS, TEXTS[::-1], TEXTS[3:]):
        ids, n = pieces.encode(*K.byte_view(pa.array(texts)))
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts_where_hashes_clash(clashing_hashes):
    held = viterbi_counts.Words(viterbi_counts.Viterbi(viterbi_counts.unigram_pieces(viterbi_counts.default_vocabulary())))
    for texts in (TEXTS, TEXTS[::-1], TEXTS[3:]):
        want = [sum(held.viterbi.count("▁" + w) for w in t.split(" ")) if t else 0 for t in texts]
        assert held.totals(*K.byte_view(pa.array(texts))).tolist() == want


def test_held_spans_are_found_after_merges():
    held, rng = K.HeldSpans(recent=50), np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000).astype(np.uint8)
    starts, sizes = np.arange(0, 4000, 8), rng.integers(0, 9, 500)
    keys = K.span_hashes(raw, starts, starts + sizes, K.BYTE_CODES)
    _, first = np.unique(keys, return_index=True)
    for part in np.array_split(np.sort(first), 13):
        part = part[np.argsort(keys[part])]
        held.add(keys[part], raw, starts[part], sizes[part])
    found = held.find(keys, raw, starts, sizes)
    assert (found >= 0).all() and len(held) == len(first)
    for i, k in enumerate(found.tolist()):
        at = int(held.starts.data[k])
        assert held.bytes.data[at : at + int(held.sizes.data[k])].tobytes() == raw[starts[i] : starts[i] + sizes[i]].tobytes()
    assert (held.find(keys ^ np.uint64(1), raw, starts, sizes) < 0).all()
