"""Prefix trie of conversations by distributed radix partitioning.

A conversation is first rebuilt: the first h turns of its family's first conversation (the one
whose id is a multiple of `FAMILY`), then its own turns after its first h, where h follows from
the CRC-32 of its id.  Turns (role, text) are dictionary-encoded; the different sequences of
ids are the classes of the trie, each with its number of conversations.

How: most significant digit first.  All classes start in the root's bucket.  A bucket of more
than `LOCAL_TURNS` turns is dealt by its next digit, one pass of Spark over all such buckets
for each depth, which emits their nodes.  Smaller buckets are finished by one task each with
multikey quicksort (a three-way partition on one digit at a time, whose equal parts are the
nodes).  A long class alone in its bucket is a chain, whose nodes its segments give on their
own.  What a subtree holds is summed upward from the buckets' tops, a depth at a time.

Scale: texts are hashed where they are read; what moves are ids of 8 bytes, in segments of at
most `SEGMENT` turns, so neither a long conversation nor a common one is one row or task.
Equal sequences are one class before buckets are made.  A range partitioning and the sizes
of its parts number the turns.  Buckets above the bound, and so the broadcasts of their keys,
number at most all turns / `LOCAL_TURNS`, and the bound grows with the square root of the turns
beyond `GROWN_FROM`.  SHA-256 of a class's ids can't be put together from parts: its ids
come sorted and packed, `PACKED` in a row, into one stream.  All that outlives a step is a
written table.

Ids of turns are 60 bits of SHA-256, classes and buckets go by 128 bits of hashes; the
dictionary is checked for two turns of one id, and hashed anew with another salt if there are.

Null role or text is empty; null turns come first; equal turns are ordered by the hash of role
and text, so repeated rows stand side by side.  Rows without conv_id belong to no
conversation and are left out.  Remainders have the sign of conv_id, as in SQL.  Very long
texts are one turn like others, and conversations of any length are cut into segments.
Further columns are not looked at.  An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import join_by_count
from .shared import grown, parts, stored, table, tasks

FAMILY, MOST_SHARED = 20, 3
SEGMENT, PACKED = 4096, 1 << 16
LOCAL_TURNS, GROWN_FROM = 1 << 15, 1 << 26
PART_TURNS = 1 << 21
WORD = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE_TYPES = [(c, pa.string() if c == "ends_sha256" else pa.int64()) for c, _ in (x.split() for x in NODE.split(", "))]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, check, tokens) of all turns, written; no two turns that differ share an id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    for salt in range(8):
        digest = F.sha2(F.concat(F.lit("" if not salt else f"{salt};"), F.length(role).cast("string"), F.lit(":"), role, text), 256)
        slim = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))
        bits = lambda a, n: F.conv(F.substring("digest", a, n), 16, 10).cast("long")
        slim = stored(slim.select("conv_id", "turn", bits(1, 15).alias("id"), bits(16, 15).alias("check"), "tokens"), "turn-ids")
        if slim.groupBy("id").agg((F.min("check") != F.max("check")).alias("two")).where("two").isEmpty():
            return slim
    raise RuntimeError("no salt keeps the turns apart")


def _segments(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, before, ids, tokens): each conversation's turns in order, in runs of a task's part; at and before: turns and tokens of the run's part before it."""

    def run(batches):
        conv, held_ids, held_tokens, at, before = None, [], [], 0, 0

        def out():
            return conv, at, before, held_ids, held_tokens

        rows: list[tuple] = []
        for batch in batches:
            convs, ids, tokens = (batch.column(c).to_numpy() for c in ("conv_id", "id", "tokens"))
            cuts = np.concatenate([[0], np.flatnonzero(convs[1:] != convs[:-1]) + 1, [len(convs)]]) if len(convs) else np.zeros(1, int)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if convs[lo] != conv:
                    if held_ids:
                        rows.append(out())
                    conv, held_ids, held_tokens, at, before = int(convs[lo]), [], [], 0, 0
                held_ids = held_ids + ids[lo:hi].tolist()
                held_tokens = held_tokens + tokens[lo:hi].tolist()
                while len(held_ids) > SEGMENT:
                    rows.append((conv, at, before, held_ids[:SEGMENT], held_tokens[:SEGMENT]))
                    at, before = at + SEGMENT, before + sum(held_tokens[:SEGMENT])
                    held_ids, held_tokens = held_ids[SEGMENT:], held_tokens[SEGMENT:]
            yield batch_of(rows)
            rows = []
        if held_ids:
            yield batch_of([out()])

    kinds = [("conv_id", pa.int64()), ("at", pa.int64()), ("before", pa.int64()), ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [c for c, _ in kinds])

    spark, order = turns.sparkSession, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    dealt = turns.repartitionByRange(tasks(spark, parts(turns.count(), PART_TURNS)), *order).sortWithinPartitions(*order).select("conv_id", "id", "tokens")
    own = dealt.mapInArrow(run, "conv_id long, at long, before long, ids array<long>, tokens array<long>").withColumn("part", F.spark_partition_id())
    own = stored(own, "turn-runs")
    size = own.groupBy("conv_id", "part").agg(F.sum(F.size("ids")).alias("n"), F.sum(_total("tokens")).alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = size.select("conv_id", "part", F.sum("n").over(earlier).alias("turns_before"), F.sum("sum").over(earlier).alias("tokens_before")).where("turns_before > 0")  # a part's first conversation at most
    joined = own.join(F.broadcast(moved), ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("at") + F.coalesce("turns_before", F.lit(0))).alias("start"), (F.col("before") + F.coalesce("tokens_before", F.lit(0))).alias("before"), "ids", "tokens")


def _total(array: str | Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, start, ids, tokens, after, turns): segments of the rebuilt conversations; after: tokens behind the segment, turns: of the whole conversation.

    A conversation without turns has one empty segment.
    """
    own = stored(_segments(turns), "segments")
    first = F.when(F.col("start") < MOST_SHARED, F.struct("start", F.slice("ids", 1, MOST_SHARED).alias("ids"), F.slice("tokens", 1, MOST_SHARED).alias("tokens")))
    convs = own.groupBy("conv_id").agg(F.sum(F.size("ids")).alias("n"), F.sum(_total("tokens")).alias("total"), F.array_sort(F.collect_list(first)).alias("first"), F.count("*").alias("members"))
    heads = [F.slice(F.flatten(F.col(f"first.{c}")), 1, MOST_SHARED).alias(f"head_{c}") for c in ("ids", "tokens")]
    convs = stored(convs.select("conv_id", "n", "total", "members", *heads), "conversations")
    base = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("head_ids").alias("base_ids"), F.col("head_tokens").alias("base_tokens"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    taken = lambda c: F.coalesce(F.slice(c, 1, F.col("h")), F.array().cast("array<long>"))
    plans = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base", "left")
    plans = plans.withColumn("base_ids", taken("base_ids")).withColumn("base_tokens", taken("base_tokens"))
    plans = plans.withColumn("shift", F.size("base_ids") - F.col("h")).withColumn("turns", F.size("base_ids") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    only_head = plans.where("n <= h").select("conv_id", F.lit(0).cast("long").alias("start"), F.col("base_ids").alias("ids"), F.col("base_tokens").alias("tokens"), F.lit(0).cast("long").alias("after"), F.col("turns").cast("long").alias("turns"))
    side = plans.where("n > h").select("conv_id", "members", "total", "h", "shift", "base_ids", "base_tokens", "turns")
    met = join_by_count(own, side, "conv_id", own.count()).where(F.col("start") + F.size("ids") > F.col("h"))
    drop = F.greatest(F.col("h") - F.col("start"), F.lit(0)).cast("int")
    holds = F.col("start") <= F.col("h")
    rest = lambda c: F.slice(c, drop + 1, F.greatest(F.size(c) - drop, F.lit(0)))
    after = F.col("total") - F.col("before") - _total("tokens")
    kept = met.select(
        "conv_id", F.when(holds, F.lit(0)).otherwise(F.col("start") + F.col("shift")).cast("long").alias("start"),
        F.when(holds, F.concat("base_ids", rest("ids"))).otherwise(F.col("ids")).alias("ids"), F.when(holds, F.concat("base_tokens", rest("tokens"))).otherwise(F.col("tokens")).alias("tokens"),
        after.alias("after"), F.col("turns").cast("long").alias("turns"),
    )
    return kept.unionByName(only_head)


def _ends(batches_key: tuple[str, ...]):
    """Runs of sorted (turns, x, y, conv_id): a row of each class, or packed ids where the class may go on in other parts."""

    def run(batches):
        key, ids, number, first, packed = None, [], 0, True, False

        def message():
            nonlocal number
            number += 1
            return (*key, number, ids[0], len(ids), None, zstandard.compress(",".join(map(str, ids)).encode(), 1))

        def closed():
            return (*key, 0, ids[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), None)

        for batch in batches:
            rows = []
            for *k, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if key is not None:
                        rows.append(message() if first or packed else closed())
                        first = False
                    key, ids, packed = k, [], False
                elif len(ids) == PACKED:
                    rows.append(message())
                    ids, packed = [], True
                ids.append(conv)
            yield out(rows)
        yield out([message()] if key is not None else [])

    kinds = (*(pa.int64() for _ in range(6)), pa.string(), pa.binary())

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*batches_key, "number", "cls", "convs", "ends", "packed"])

    return run


def _streamed(batches):
    """Classes of packed ids that come in order: (cls, convs, turns, ends)."""
    key, cls, convs, sha = None, None, 0, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["cls", "convs", "turns", "ends"])

    for batch in batches:
        rows = []
        for turns, x, y, first, n, packed in zip(*(batch.column(c).to_pylist() for c in ("turns", "x", "y", "cls", "convs", "packed"))):
            if (turns, x, y) != key:
                if key is not None:
                    rows.append((cls, convs, key[0], sha.hexdigest()))
                key, cls, convs, sha = (turns, x, y), first, 0, hashlib.sha256()
            sha.update((b"," if convs else b"") + zstandard.decompress(packed))
            convs += n
        yield out(rows)
    yield out([(cls, convs, key[0], sha.hexdigest())] if key is not None else [])


def classes(segments: DataFrame) -> DataFrame:
    """(cls: smallest conversation, convs, turns, ends: SHA-256 of all its ids) of each different rebuilt sequence."""
    mixed = lambda seed: F.expr(f"aggregate(transform(ids, (x, i) -> xxhash64(x, start + i, {seed}L)), 0L, (a, x) -> a ^ x)")
    each = segments.select("conv_id", "turns", mixed(11).alias("x"), mixed(23).alias("y")).groupBy("conv_id").agg(F.max("turns").alias("turns"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    key = ("turns", "x", "y")
    each = stored(each.select(*key, "conv_id"), "sequences")
    n = tasks(each.sparkSession, parts(each.count(), PART_TURNS))
    runs = each.repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(_ends(key), "turns long, x long, y long, number long, cls long, convs long, ends string, packed binary")
    runs = stored(runs, "class-runs")
    whole = runs.where("ends is not null").select("cls", "convs", "turns", "ends")
    cut = runs.where("ends is null").repartition(tasks(each.sparkSession, 1), *key).sortWithinPartitions(*key, "cls").drop("number", "ends")
    return whole.unionByName(cut.mapInArrow(_streamed, "cls long, convs long, turns long, ends string"))


def bucket_nodes(sequences: list[tuple], depth: int, parent: int | None) -> dict[str, list]:
    """Nodes of one bucket, its top first: columns of NODE.

    sequences: (cls, convs, turns, ends, start, ids, tokens) of different classes that share their first `depth` turns; ids
    and tokens are those from `start` (at most depth) on.
    """
    conv, level, above, convs, words, ends = ([] for _ in range(6))

    def node(members: list[tuple], d: int, of: int) -> int:
        conv.append(min(s[0] for s in members))
        level.append(d)
        above.append(of)
        convs.append(sum(s[1] for s in members))
        words.append(members[0][6][d - 1 - members[0][4]] if d - 1 >= members[0][4] and d else 0)
        ends.append(next((s[3] for s in members if s[2] == d), NO_ENDS))
        return len(conv) - 1

    work = [(sequences, depth, node(sequences, depth, -1))]
    while work:
        members, d, of = work.pop()
        if len(members) == 1:  # nothing left to part: one chain
            (cls, many, turns, end, start, _, tokens), k = members[0], members[0][2] - d
            if k > 0:
                at = len(conv)
                conv += [cls] * k
                level += range(d + 1, turns + 1)
                above += [of, *range(at, at + k - 1)]
                convs += [many] * k
                words += tokens[d - start : turns - start]
                ends += [NO_ENDS] * (k - 1) + [end]
            continue
        live = [s for s in members if s[2] > d]
        if not live:
            continue
        pivot = live[len(live) // 2]
        digit = pivot[5][d - pivot[4]]
        less, same, more = [], [], []
        for s in live:
            x = s[5][d - s[4]]
            (less if x < digit else more if x > digit else same).append(s)
        work += [(side, d, of) for side in (less, more) if side]
        work.append((same, d + 1, node(same, d + 1, of)))
    children, leaves = [0] * len(conv), [0] * len(conv)
    saved = [(n - 1) * w for n, w in zip(convs, words)]
    for i in range(len(conv) - 1, -1, -1):  # parents stand before their children
        leaves[i] = leaves[i] or 1
        if (of := above[i]) >= 0:
            children[of] += 1
            leaves[of] += leaves[i]
            saved[of] += saved[i]
    return dict(zip(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"), (conv, level, [parent if p < 0 else conv[p] for p in above], convs, children, leaves, saved, ends)))


_TOP = NODE + ", top boolean"


def _batch(columns: dict[str, list], top: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(columns[c], t) for c, t in _NODE_TYPES), pa.array(top)], [*(c for c, _ in _NODE_TYPES), "top"])


def _finished(batches):
    """All nodes of small buckets, whose segments come sorted by (k1, k2, cls, start)."""
    key, held, made, tops = None, {}, [], []

    def close():
        got = bucket_nodes([(*k, start, ids, tokens) for k, (start, ids, tokens) in held.items()], key[2], key[3])
        made.append(got)
        tops.extend([True] + [False] * (len(got["conv_id"]) - 1))

    def flush():
        nonlocal made, tops
        out = _batch({c: [x for m in made for x in m[c]] for c, _ in _NODE_TYPES}, tops)
        made, tops = [], []
        return out

    for batch in batches:
        for k1, k2, depth, parent, cls, convs, turns, ends, start, ids, tokens in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "depth", "parent", "cls", "convs", "turns", "ends", "start", "ids", "tokens"))):
            if (k1, k2, depth, parent) != key:
                if key is not None:
                    close()
                    if len(tops) > 1 << 14:
                        yield flush()
                key, held = (k1, k2, depth, parent), {}
            mine = held.setdefault((cls, convs, turns, ends), (start, [], []))
            mine[1].extend(ids)
            mine[2].extend(tokens)
    if key is not None:
        close()
    yield flush()


def _chained(batches):
    """Nodes below depth - 1 of classes that are alone in their buckets, segment by segment."""
    for batch in batches:
        for depth, parent, cls, convs, turns, ends, start, ids, tokens, after in zip(*(batch.column(c).to_pylist() for c in ("depth", "parent", "cls", "convs", "turns", "ends", "start", "ids", "tokens", "after"))):
            lo, hi = max(start, depth - 1), start + len(ids)  # places of the last turns of the nodes
            if lo >= hi:
                continue
            k = hi - lo
            rest = (int(after) + np.cumsum(np.array(tokens[lo - start :], np.int64)[::-1])[::-1]) * (convs - 1)
            last = hi == turns
            columns = {"conv_id": [cls] * k, "depth": list(range(lo + 1, hi + 1)), "parent_conv_id": [parent if lo == depth - 1 else cls] + [cls] * (k - 1), "n_convs": [convs] * k}
            columns |= {"n_children": [1] * (k - 1) + [0 if last else 1], "n_leaves": [1] * k, "saved_tokens": rest.tolist(), "ends_sha256": [NO_ENDS] * (k - 1) + [ends if last else NO_ENDS]}
            yield _batch(columns, [lo == depth - 1] + [False] * (k - 1))


_ROW = ("k1", "k2", "depth", "parent", "cls", "convs", "turns", "ends", "start", "ids", "tokens", "after")


def trie(conversations: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, turn, role, text): columns of NODE."""
    spark = conversations.sparkSession
    segments = stored(rebuilt(encoded_turns(conversations)), "rebuilt")
    known = stored(classes(segments), "classes")
    whole = known.agg(F.min("cls").alias("node"), F.sum("turns").cast("long").alias("turns"), F.sum("convs").alias("convs"), F.max(F.when(F.col("turns") == 0, F.col("ends"))).alias("ends")).first()
    if whole["node"] is None:
        return spark.createDataFrame([], NODE)
    most = grown(local_turns, whole["turns"], GROWN_FROM)
    n_segments = segments.count()
    members = segments.groupBy("conv_id").agg(F.count("*").alias("members"))
    reps = known.select(F.col("cls").alias("conv_id"), "convs", "ends").join(members, "conv_id")
    rows = join_by_count(segments, reps, "conv_id", n_segments).withColumnRenamed("conv_id", "cls")
    rows = rows.select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), *_ROW[4:])
    small, chains, levels = [], [], []
    if whole["turns"] <= most:
        small.append(rows)
    else:
        levels.append(spark.createDataFrame([(whole["node"], 0, None, whole["convs"], 0, whole["ends"] or NO_ENDS)], "conv_id long, depth long, parent_conv_id long, n_convs long, own long, ends_sha256 string"))
        rows = stored(rows.withColumn("parent", F.lit(whole["node"]).cast("long")), "bucket-0")
    depth = 0
    while levels and rows is not None:  # rows: of the buckets above the bound at this depth; parent is their node
        place = F.lit(depth) - F.col("start")
        here = (F.col("start") <= depth) & (F.lit(depth) < F.col("start") + F.size("ids"))
        at = lambda c: F.element_at(c, (place + 1).cast("int"))
        digits = rows.where(here).withColumn("digit", at("ids")).withColumn("own", at("tokens"))
        digits = digits.withColumn("k1", F.xxhash64("k1", "digit", F.lit(5))).withColumn("k2", F.xxhash64("k2", "digit", F.lit(7))).withColumn("depth", F.lit(depth + 1).cast("long"))
        further = rows.where(F.col("start") > depth)
        if not further.isEmpty():
            more = F.col("turns") > F.col("start") + F.size("ids")
            side = digits.where(more).select("cls", F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.ceil(F.col("turns") / SEGMENT).alias("members"))
            met = join_by_count(further, side, "cls", n_segments).withColumn("k1", F.col("j1")).withColumn("k2", F.col("j2")).withColumn("depth", F.lit(depth + 1).cast("long"))
            moved = stored(digits.select(*_ROW, "own").unionByName(met.select(*_ROW, F.lit(None).cast("long").alias("own"))), "dealt")
        else:
            moved = stored(digits.select(*_ROW, "own"), "dealt")
        first = moved.where("own is not null")
        left = F.col("turns") - F.lit(depth)
        stats = first.groupBy("k1", "k2").agg(F.min("cls").alias("node"), F.count("*").alias("n_classes"), F.sum(left).alias("weight"), F.sum("convs").alias("n_convs"), F.max("own").alias("own"), F.max("parent").alias("above"), F.max(F.when(F.col("turns") == depth + 1, F.col("ends"))).alias("ended"))
        large = stored(stats.where(F.col("weight") > most), "large-buckets")  # at most all turns / most rows
        key = ["k1", "k2"]
        small.append(moved.join(F.broadcast(large.select(*key)), key, "left_anti").select(*_ROW))
        alone = large.where("n_classes = 1")
        chains.append(moved.join(F.broadcast(alone.select(*key)), key, "left_semi").select(*_ROW))
        going = large.where("n_classes > 1")
        if going.isEmpty():
            break
        depth += 1
        levels.append(going.select(F.col("node").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("above").alias("parent_conv_id"), "n_convs", "own", F.coalesce("ended", F.lit(NO_ENDS)).alias("ends_sha256")))
        rows = stored(moved.join(F.broadcast(going.select(*key, "node")), key).withColumn("parent", F.col("node")).select(*_ROW), f"bucket-{depth}")
    finish = small[0]
    for more in small[1:]:
        finish = finish.unionByName(more)
    dealt = finish.repartition(tasks(spark, parts(whole["turns"], 4 * most)), "k1", "k2").sortWithinPartitions("k1", "k2", "depth", "cls", "start")
    nodes = dealt.mapInArrow(_finished, _TOP)
    for chain in chains:
        nodes = nodes.unionByName(chain.mapInArrow(_chained, _TOP))
    nodes = stored(nodes, "nodes")
    names = [c for c, _ in _NODE_TYPES]
    result, upper = nodes.select(*names), None
    for d in range(len(levels) - 1, -1, -1):
        below = nodes.where(F.col("top") & (F.col("depth") == d + 1)).select(*names)
        below = below if upper is None else below.unionByName(upper)
        sums = below.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        upper = levels[d].join(sums, "conv_id").withColumn("saved_tokens", F.col("below") + (F.col("n_convs") - 1) * F.col("own")).select(*names)
        upper = stored(upper, "upper-nodes")
        result = result.unionByName(upper)
    return result


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


SQL = rf"""WITH slots AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS slot FROM range(256) r(n)),
own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
held AS (
  SELECT conv_id, turns, xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))), lambda c, x: xor(c // 256, slot[xor(c % 256, x) + 1]), 4294967295::BIGINT), 4294967295) % 4 AS h
  FROM own, slots),
rebuilt AS (SELECT a.conv_id, coalesce(b.turns[1:a.h], []) || coalesce(a.turns[a.h + 1:], []) AS turns FROM held a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}),
steps AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
paths AS (SELECT conv_id, depth, min(conv_id) OVER (PARTITION BY depth, turns[1:depth]) AS node, CASE WHEN depth > 0 THEN turns[depth].text END AS last, depth = len(turns) AS ends FROM steps),
nodes AS (
  SELECT node, depth, count(*) AS n, coalesce(len(regexp_extract_all(any_value(last), '{WORD}')), 0) AS tokens, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM paths GROUP BY 1, 2),
placed AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN paths p ON p.conv_id = n.node AND p.depth = n.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM placed WHERE depth > 0 GROUP BY 1, 2),
full_ AS (SELECT placed.*, coalesce(n_children, 0) AS n_children FROM placed LEFT JOIN children USING (node, depth)),
sums AS (SELECT p.node, p.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n - 1) * tokens) AS saved FROM full_ f JOIN paths p ON p.conv_id = f.node AND p.depth <= f.depth GROUP BY 1, 2)
SELECT node AS conv_id, depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, ends_sha256 FROM full_ JOIN sums USING (node, depth)"""
