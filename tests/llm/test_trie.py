from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from llm_cases import clashing
from rows import same_rows

from tickforge.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Nodes from a dictionary of all prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, own.get(c - int(c % 20 if c >= 0 else -(-c % 20)), [])
        made[c] = tuple(base[:h] + turns[h:])
    members: dict = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids: dict = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        mine = kids.get(p, [])
        leaves = sum(out[k][5] for k in mine) or 1
        words = len(WORD.findall(p[-1][1])) if p else 0
        saved = (len(members[p]) - 1) * words + sum(out[k][6] for k in mine)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(made[c]) == len(p))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(mine), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=lambda r: (r[1], r[0]))


def check(spark, rows, **how):
    got = T.trie(spark.createDataFrame(rows, SCHEMA), **how)
    assert [c for c in got.columns] == [c for c, _ in T._NODE_TYPES]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[1], r[0])) == brute(rows)


def conversations(seed: int, n: int, turns: int = 5, variety: int = 3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), f"t{rng.randrange(variety)} word") for c in range(n) for t in range(rng.randrange(turns + 1))]


def test_query_equals_sql_and_brute_force(spark, tiny, duck):
    same_rows(T.query(spark, tiny).toPandas(), duck.sql(T.SQL).df())
    check(spark, [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("local_turns", [1, 8, 10**6])
def test_buckets_of_all_sizes(spark, local_turns):
    check(spark, conversations(local_turns % 97, 130), local_turns=local_turns)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (7, None, None, "null turn"), (7, None, None, None), (7, 3, "user", ""), (7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (8, 0, "user", "again"), (8, 0, "user", "again"), (-45, 0, "user", "minus"), (-40, 0, "u", "minus base")]
    rows += [(c, 0, "user", "one turn") for c in (10, 11, 12, 13, 61, 62, 63, 64)]
    check(spark, rows)
    check(spark, rows, local_turns=1)


def test_copies_of_one_conversation_and_a_long_one(spark, monkeypatch):
    """A third of all conversations alike, and a long one with copies, over segments and chains, and packed ids over several parts."""
    monkeypatch.setattr(T, "SEGMENT", 16)
    monkeypatch.setattr(T, "PACKED", 7)
    monkeypatch.setattr(T, "PART_TURNS", 150)
    long = [(c, t, "user", f"long {t} of many words") for c in (1020, 1031, 1033) for t in range(180)]
    fork = [(1041, t, "user", f"long {t} of many words" if t < 100 else f"fork {t}") for t in range(140)]
    rows = [(c, t, "user", f"same {t}") for c in range(2000, 2080) for t in range(4)] + conversations(5, 80) + long + fork
    check(spark, rows, local_turns=60)
    check(spark, rows, local_turns=10)


def test_very_long_texts_extra_columns_and_empty_table(spark):
    rows = [(0, 0, "user", "word " * 200_000), (1, 0, "user", "word " * 200_000), (2, 0, "x" * 1000, "\n\t ")]
    check(spark, rows)
    df = clashing(spark.createDataFrame(rows[2:], SCHEMA), "id", "digest", "part", "start", "k1", "depth", "cls")
    assert [tuple(r) for r in T.trie(df).collect()] == [tuple(r) for r in T.trie(df.select("conv_id", "turn", "role", "text")).collect()]
    assert T.trie(df.where("false")).count() == 0
