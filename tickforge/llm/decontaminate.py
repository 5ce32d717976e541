"""Benchmark decontamination by Wu-Manber search of many strings.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all non-ASCII bytes.  A
window is `size` consecutive words of a benchmark item; an item of fewer words, but not
none, is one window.  A document word inside any occurrence of a window is hit.

How: a slice of documents becomes one normalised stream, words separated by one space.
Windows are sorted into classes by length, and each class has the tables of Wu-Manber: for
each block of bytes the shift that cannot skip an occurrence, and for blocks that end the
first m bytes of a string, the bucket of those strings, which are compared directly.  Many
lanes of the stream are searched in step, so that a step is a few numpy calls.

Scale: documents are read once and not shuffled.  The windows of the benchmark are written by
tasks, in files of about `part_bytes` of benchmark text.  A worker holds one part's tables at
a time, and keeps them from task to task where there is but one; a larger benchmark is
searched part by part for each `HELD_BYTES` of documents, so memory doesn't grow with it.

Null or wordless documents have no words and are clean; null items have no windows; items
may repeat, as may documents.  A very long document is one stream, in memory in proportion
to it.  An empty table gives no rows; an empty benchmark hits nothing.  Further columns are
not looked at.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .kernel import _LOWER, byte_view, slices, word_spans
from .shared import fresh_path, parts, stored, table, text_bytes

SIZE = 10
PART_BYTES, HELD_BYTES = 8 << 20, 64 << 20
LANE = 1024
#: Bytes outside words: ASCII but 0-9, A-Z and a-z.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Least length of a class of strings, and its block size in bytes.
CLASSES = ((32, 8), (16, 8), (8, 4), (1, 2))


def item_windows(items: list[tuple[str, str | None]], size: int = SIZE) -> dict[bytes, set[str]]:
    """Each window, as normalised bytes between spaces, with the ids of the items that hold it."""
    windows: dict[bytes, set[str]] = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), BETWEEN)
        low = _LOWER[raw].tobytes()
        words = [low[a:b] for a, b in zip(starts, ends)]
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(b" " + b" ".join(words[k : k + size]) + b" ", set()).add(item)
    return windows


class WuManber:
    """Tables for strings of at least `least` bytes, with blocks of 2, 4 or 8 bytes."""

    def __init__(self, strings: list[bytes], block: int):
        self.strings, self.block = strings, block
        self.m = min(map(len, strings))
        bits = 16 if block == 2 else min(22, max(16, 6 + (len(strings) * self.m).bit_length()))
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.m - block + 1, np.int32)
        self.buckets: dict[int, list[int]] = {}
        heads = np.frombuffer(b"".join(s[: self.m] for s in strings), np.uint8).reshape(len(strings), self.m)
        for end in range(block, self.m + 1):
            keys = self._key(np.ascontiguousarray(heads[:, end - block : end]).view(f"<u{block}").ravel())
            np.minimum.at(self.shift, keys, self.m - end)
        for i, k in enumerate(keys.tolist()):
            self.buckets.setdefault(k, []).append(i)

    def _key(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)) >> self.drop).astype(np.int64)

    def search(self, stream: bytes) -> list[tuple[int, int]]:
        """(start, string) of every occurrence."""
        last = len(stream) - self.m
        if last < 0:
            return []
        blocks = np.ndarray((len(stream) - self.block + 1,), f"<u{self.block}", stream, strides=(1,))
        at = np.arange(0, last + 1, LANE)
        end = np.minimum(at + LANE, last + 1)
        found = []
        tail = self.m - self.block
        while len(at):
            keys = self._key(blocks[at + tail])
            step = self.shift[keys]
            zero = np.flatnonzero(step == 0)
            for p, k in zip(at[zero].tolist(), keys[zero].tolist()):
                for i in self.buckets[k]:
                    if stream.startswith(self.strings[i], p):
                        found.append((p, i))
            at = at + np.maximum(step, 1)
            go = at < end
            at, end = at[go], end[go]
        return found


def searchers(windows: list[bytes]) -> list[WuManber]:
    out, rest = [], windows
    for least, block in CLASSES:
        own = [w for w in rest if len(w) >= least]
        rest = [w for w in rest if len(w) < least]
        if own:
            out.append(WuManber(own, block))
    return out


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(stream, place of each word in it, document of each word); a zero byte comes before each document's words."""
    base = int(offsets[0])
    starts, ends, doc = word_spans(data, offsets, BETWEEN)
    if not len(starts):
        return b"", starts, doc
    size = ends - starts
    head = np.ones(len(starts), bool)
    head[1:] = doc[1:] != doc[:-1]
    place = np.cumsum(size + 1 + 2 * head) - size - 1
    stream = np.full(int(place[-1] + size[-1] + 1), 0x20, np.uint8)
    stream[place[head] - 2] = 0
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    stream[np.repeat(place, size) + within] = _LOWER[data[base + np.repeat(starts, size) + within]]
    return stream.tobytes(), place, doc


_FOUND = "doc_id long, n_words long, hits array<struct<start: long, end: long>>, items array<string>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Search:
    """The tables of some windows, and what they find in texts."""

    def __init__(self, windows: dict[bytes, set[str]]):
        self.windows, self.tools = windows, searchers(sorted(windows))
        self.words_of = {w: w.count(b" ") - 1 for w in windows}

    def texts(self, column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set[str]]]]:
        """(words of each text, {text: (runs of hit words, items)})."""
        data, offsets = byte_view(column)
        n, found = np.zeros(len(offsets) - 1, np.int64), {}
        for lo, hi in slices(offsets):
            stream, place, doc = normalised(data, offsets[lo : hi + 1])
            n[lo:hi] = counts = np.bincount(doc, minlength=hi - lo)
            first = np.cumsum(counts) - counts
            for tool in self.tools:
                got = tool.search(stream)
                at = np.searchsorted(place, np.array([p for p, _ in got], np.int64) + 1)
                for w, (_, i) in zip(at.tolist(), got):
                    d = int(doc[w])
                    runs, names = found.setdefault(lo + d, ([], set()))
                    runs.append((w - int(first[d]), w - int(first[d]) + self.words_of[tool.strings[i]]))
                    names.update(self.windows[tool.strings[i]])
        return n, found


@lru_cache(maxsize=1)
def _search(uri: str | None) -> Search:
    """The tables of one part, the worker's own; kept from task to task while no other part is asked for."""
    return Search(pickle.loads(files.get(uri)) if uri else {})


def _held(batches, at: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about `most` bytes of text."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.column(at).nbytes
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _searched(batches, uris: list[str], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, dict[int, tuple[list[dict], list[str]]]]]:
    """(batch, words of each text, {text: (maximal runs of hit words, items)}) after a search for all parts in turn."""
    for group in _held(batches, at, HELD_BYTES if len(uris) > 1 else 0):
        words: list = [None] * len(group)
        found: list[dict] = [{} for _ in group]
        for uri in uris or [None]:
            search = _search(uri)
            for k, batch in enumerate(group):
                words[k], got = search.texts(batch.column(at))
                for d, (runs, names) in got.items():
                    held = found[k].setdefault(d, ([], set()))
                    held[0].extend(runs)
                    held[1].update(names)
        for batch, n, got in zip(group, words, found):
            out = {}
            for d, (runs, names) in got.items():
                merged: list[dict] = []
                for lo, hi in sorted(runs):
                    if merged and lo <= merged[-1]["end"]:
                        merged[-1]["end"] = max(hi, merged[-1]["end"])
                    else:
                        merged.append({"start": lo, "end": hi})
                out[d] = merged, sorted(names)
            yield batch, n, out


def window_parts(benchmark: DataFrame, size: int = SIZE, item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES) -> list[str]:
    """Files of the benchmark's windows in the shared folder, each of about part_bytes of text; tasks write them."""
    path = fresh_path(benchmark.sparkSession, "windows")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    total = parts(items.agg(F.sum(text_bytes("text")).alias("n")).first()["n"], part_bytes)

    def write(part: pa.Table) -> pa.Table:
        uri = f"{path}/{uuid.uuid4().hex}.windows"
        files.put(uri, pickle.dumps(item_windows(list(zip(part.column("item").to_pylist(), part.column("text").to_pylist())), size)))
        return pa.table({"uri": [uri]})

    written = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(total))).groupBy("part").applyInArrow(write, "uri string")
    return sorted(r["uri"] for r in stored(written, "window-parts").collect())  # a short row for each part_bytes of the benchmark


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of the benchmark occurs."""
    at, uris = docs.columns.index(text_col), window_parts(benchmark, size, part_bytes=part_bytes)

    def run(batches):
        for batch, _, found in _searched(batches, uris, at):
            keep = np.ones(batch.num_rows, bool)
            keep[list(found)] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_words, hits: array of maximal [start, end) runs of hit words, items: array of item ids as strings, sorted) of every row."""
    uris = window_parts(benchmark, size, item_col, item_text_col, part_bytes)

    def run(batches):
        for batch, n, found in _searched(batches, uris, 1):
            hits, items = [[] for _ in n], [[] for _ in n]
            for d, (runs, names) in found.items():
                hits[d], items[d] = runs, names
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(hits, _RUNS), pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "hits", "items"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _FOUND)


def with_digests(found: DataFrame) -> DataFrame:
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


#: The same rows by brute force: every window of every document against every window of every item.
SQL = r"""
WITH bw AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS s, least(len(w), 10) AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM bw WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
places AS (
  SELECT doc_id, i, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, k, item FROM places JOIN win USING (s, k)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""
