from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose
from llm_cases import clashing, edge_texts

from tickforge.llm import suffix_dedup as S


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        cover, end = bytearray(len(t)), 0
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                cover[max(i, end) : i + width] = b"\1" * (i + width - max(i, end))
                end = i + width
        runs = sum(1 for i, x in enumerate(cover) if x and not (i and cover[i - 1]))
        out.append((d, len(t), sum(cover), runs, hashlib.sha256(bytes(x for x, c in zip(t, cover) if not c)).hexdigest()))
    return out


def check(df, width=S.WIDTH, **how):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = []
    for r in S.remove_repeats(df, width=width, **how).collect():
        removed = sum(x["end"] - x["start"] for x in r["removed"])
        assert r["n_bytes"] - removed == len(r["kept"])
        got.append((r["doc_id"], r["n_bytes"], removed, len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()))
    assert sorted(got, key=str) == sorted(brute(rows, width), key=str)


def test_smallest_data(spark, tiny):
    check(spark.read.parquet(f"{tiny}/documents.parquet"))


def test_passages_in_many_contexts(documents):
    """One passage in more contexts than an anchor's group may have, so that windows are compared by hash."""
    passage = prose(45, 1)
    docs = [f"{prose(30, 100 + i)} {passage} {prose(30, 500 + i)}" for i in range(60)] + [f"{passage[:210]} {prose(9, 7)}", passage[50:], prose(400, 3), f"{prose(60, 4)} {prose(60, 4)}"]
    check(documents(*docs))
    check(documents(*docs), chunk_bytes=3000, bucket_bytes=4000)


def test_keys_of_segments_reach_all_buckets_alike():
    """Anchors are chosen by least hash; as keys such hashes would nearly all go to the first bucket."""
    data = np.frombuffer(prose(20_000, 5).encode(), np.uint8)
    keys = S.anchored_segments(data, np.array([0, len(data)]), S.WIDTH, S.ANCHOR)["key1"]
    share = np.bincount((S.coded(np.sort(keys), 16) >> np.uint64(32)).astype(int), minlength=16) / len(keys)
    assert len(keys) > 500 and share.max() < 0.15 and share.min() > 0.02


def test_small_width_and_periods(documents):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(40)] + ["a" * 100, "ab" * 60, "abcabcabc" * 9]
    check(documents(*texts), width=12, anchor=4)


def test_edges(documents):
    texts = [t for t in edge_texts() if t is None or len(t) < 10_000]
    check(documents(*texts, "long words here " * 300 + "end", (7, prose(60, 9)), (7, prose(60, 9)), (None, prose(60, 9)), "é" * 150, "é" * 150 + "x"))


def test_very_long_text_is_cut_into_parts(documents, monkeypatch):
    data = np.frombuffer((prose(3000, 2) + prose(3000, 2)).encode(), np.uint8)
    whole = S.anchored_segments(data, np.array([0, len(data)]), 200, 32)
    windows = set()
    monkeypatch.setattr(S, "PIECE", 5000)
    for _, base, local in S._pieces(np.array([0, len(data)]), 200):
        got = S.anchored_segments(data[base : base + int(local[-1])], local, 200, 32)
        for a, n, off, key in zip(got["start"], got["windows"], got["off"], got["key1"]):
            windows |= {(base + a + j, base + a + off, key) for j in range(n)}
    assert windows == {(a + j, a + off, key) for a, n, off, key in zip(whole["start"], whole["windows"], whole["off"], whole["key1"]) for j in range(n)}


@pytest.mark.parametrize("seed", range(6))
def test_column_wise_order_finds_equal_windows(seed):
    rng = random.Random(seed)
    width, anchor = 8, 3
    texts, off, windows, group = [], [], [], []
    for g in range(4):
        for _ in range(rng.randrange(1, 7)):
            o, n = rng.randrange(width - anchor + 1), rng.randrange(1, 4)
            n = min(n, o + 1)
            texts.append(bytes(rng.choice(b"ab") for _ in range(n - 1 + width)))
            off.append(o)
            windows.append(n)
            group.append(g)
    flags = S.repeated_windows(texts, np.array(off), np.array(windows), np.array(group), width, width - anchor)
    held = Counter((g, o - j, t[j : j + width]) for t, o, n, g in zip(texts, off, windows, group) for j in range(n))
    for i, (t, o, n, g) in enumerate(zip(texts, off, windows, group)):
        assert flags[i, :n].tolist() == [held[g, o - j, t[j : j + width]] > 1 for j in range(n)]


def test_extra_columns_and_empty_table(documents):
    df = clashing(documents(prose(80, 1), prose(80, 1)), "chunk", "kept", "row", "id", "bytes")
    assert [len(r["kept"]) for r in S.remove_repeats(df).collect()] == [0, 0]
    assert S.remove_repeats(df.limit(0)).count() == 0
