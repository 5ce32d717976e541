"""Suffix-array removal of repeated byte strings, with columns inserted one at a time.

Every byte that a `width`-byte string covers which also starts anywhere else in the corpus,
the same document included, is removed; overlaps count and strings are judged on the input.

How: the collection is cut into short strings whose windows could repeat, and those are
sorted by column-wise construction.  Each window of `width` bytes has an anchor, the
leftmost `anchor`-byte string of least hash in it; windows that share an anchor occurrence
form a segment.  Equal windows have equal anchors at equal distances, so only segments of
one anchor need each other, and in them equal windows stand in the same column.  For each
batch of anchors, rounds go from the last column to the first; a round inserts one symbol
of every segment: the column of symbols before the sorted suffixes (the round's part of the
collection's Burrows-Wheeler transform) sorts the longer suffixes stably, and their common
prefixes follow from the least common prefix between neighbours.  As segments are aligned,
only the newest suffix of each segment is carried, so a round costs one symbol a segment.
Windows whose common prefix with a neighbour reaches `width` repeat.

Scale: chunks of documents (by a hash of id and text) send sorted keys of their segments to
buckets of the anchor space and get a verdict for each back: alone (nearly all), repeated
whole, or to be compared.  Only segments to be compared carry text.  Whole segments are equal
by hashes of their anchor and of all their bytes, 128 bits in all.  An anchor with more than
`HOT_ANCHOR` different segments, or more than `HOT_IN_CHUNK` in one chunk (a common phrase in
many contexts), would make a group without bound; its windows are compared by 128 bits of
two hashes of all their bytes, counted per chunk first.  Chunks and buckets grow with the
square root of the corpus beyond `GROWN_FROM` bytes, so that messages grow with the corpus.

Nulls are empty texts.  Repeated rows repeat each other and are removed whole (if long
enough).  Texts under `width` bytes are kept whole.  A very long text is a chunk of its own
and is worked through in overlapping pieces.  An empty table gives no rows.  Further columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import _BYTE_CODE, _spread, BYTE_CODES, Sums, U64, byte_view, powers, slices
from .packing import by_bucket, coded, squeeze, unsqueeze
from .shared import grown, parts, stored, table, tasks, text_bytes

WIDTH, ANCHOR = 200, 32
CHUNK_BYTES, BUCKET_BYTES, GROWN_FROM = 4 << 20, 16 << 20, 32 << 30
HOT_ANCHOR, HOT_IN_CHUNK = 256, 16
BATCH_BYTES = 4 << 20
PIECE = 4 << 20
ALONE, WHOLE, FIRST, HOT, COMPARE = range(5)
_PLACE = U64((1 << 24) - 1)
TRIPLE = np.dtype([("row", np.int64), ("lo", np.int64), ("hi", np.int64)])


def _pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, first byte, local offsets): slices of rows, and overlapping parts of very long texts."""
    for lo, hi in slices(offsets):
        start, end = int(offsets[lo]), int(offsets[hi])
        if hi - lo == 1 and end - start > PIECE + width:
            for at in range(start, end - width + 1, PIECE):
                yield lo, at, np.array([0, min(PIECE + width - 1, end - at)])
        elif end - start >= width:
            yield lo, start, offsets[lo : hi + 1] - start


def anchored_segments(data: np.ndarray, offsets: np.ndarray, width: int, anchor: int) -> dict[str, np.ndarray]:
    """Segments of the texts data[offsets[i]:offsets[i+1]]: doc, start (of its first window), windows, off (of its anchor from start), key1 (anchor), key2 (all bytes)."""
    n, w = len(data), width - anchor + 1
    up, down = powers(n)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE_CODE[data] * up[:n], out=total[1:])
    hashes = _spread((total[anchor:] - total[:-anchor]) * down[: n - anchor + 1])
    ranked = np.full(-(-len(hashes) // w) * w, ~U64(0))
    ranked[: len(hashes)] = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=U64)
    blocks = ranked.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(back[: n - width + 1], ahead[w - 1 : w + n - width]) & _PLACE).astype(np.int64)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, offsets[:-1], 1)
    np.add.at(edge, np.maximum(offsets[:-1], offsets[1:] - width + 1), -1)
    starts = np.flatnonzero(np.cumsum(edge)[: n - width + 1] > 0)
    at = least[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (at[1:] != at[:-1]) | (np.diff(starts) != 1)
    head = np.flatnonzero(first)
    size = np.diff(np.append(head, len(starts)))
    start, off = starts[head], at[head] - starts[head]
    end = start + size - 1 + width
    key2 = _spread(Sums(data, BYTE_CODES).spans(start, end) ^ off.astype(U64) * U64(0x9E3779B97F4A7C15))
    key1 = _spread(hashes[at[head]])  # anchors have least hashes, which would all go to the first buckets
    return {"doc": np.searchsorted(offsets, start, "right") - 1, "start": start, "windows": size, "off": off, "key1": key1, "key2": key2}


def _chunk_rows(chunk: pa.Table) -> tuple[list, pa.Array]:
    """Ids and texts of a chunk in an order that doesn't depend on how they came."""
    ids, texts = chunk.column("id").to_pylist(), chunk.column("text").combine_chunks()
    key = (lambda i: (ids[i] is not None, ids[i] or 0)) if len(set(ids)) == len(ids) else (lambda i: (ids[i] is not None, ids[i] or 0, texts[i].as_py() or ""))
    order = sorted(range(len(ids)), key=key)
    return [ids[i] for i in order], texts.take(pa.array(order, pa.int64()))


def _chunk_segments(texts: pa.Array, width: int, anchor: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(segments with row, start in the row, and byte `at`; all bytes; offsets)."""
    data, offsets = byte_view(texts)
    found: dict[str, list] = {k: [np.zeros(0, t)] for k, t in (("row", np.int64), ("start", np.int64), ("at", np.int64), ("windows", np.int64), ("off", np.int64), ("key1", U64), ("key2", U64))}
    for row, base, local in _pieces(offsets, width):
        got = anchored_segments(data[base : base + int(local[-1])], local, width, anchor)
        got["row"] = row + got.pop("doc")
        got["at"] = base + got["start"]
        got["start"] = got["at"] - offsets[got["row"]]
        for k, v in found.items():
            v.append(got[k])
    return {k: np.concatenate(v) for k, v in found.items()}, data, offsets


def _entries(seg: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key1, key2, count) of the chunk's different segments by key1 and key2, and each segment's entry; many of one anchor are one entry of count 0."""
    order = np.lexsort((seg["key2"], seg["key1"]))
    k1, k2 = seg["key1"][order], seg["key2"][order]
    new1, new = np.ones(len(order), bool), np.ones(len(order), bool)
    new1[1:] = k1[1:] != k1[:-1]
    new[1:] = new1[1:] | (k2[1:] != k2[:-1])
    anchor = np.cumsum(new1) - 1
    different = np.bincount(anchor, weights=new).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    crowded = different[anchor] > HOT_IN_CHUNK if len(order) else np.zeros(0, bool)
    new &= ~crowded | new1
    entry = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(order)))
    counts[crowded[heads]] = 0
    of = np.empty(len(order), np.int64)
    of[order] = entry
    return k1[heads], np.where(crowded[heads], U64(0), k2[heads]), counts.astype(np.uint32), of


def _verdicts(bucket: pa.Table) -> pa.Table:
    """A verdict for each entry that chunks sent to the bucket."""
    read = lambda c, t: [unsqueeze(x, t) for x in bucket.column(c).to_pylist()]
    k1s, k2s, counts = read("key1", U64), read("key2", U64), np.concatenate(read("counts", np.uint32)).astype(np.int64)
    cuts = np.cumsum([0, *map(len, k1s)])
    k1, k2 = np.concatenate(k1s), np.concatenate(k2s)
    order = np.lexsort((np.arange(len(k1)), k2, k1))
    k1, k2, counts = k1[order], k2[order], counts[order]
    new1, new = np.ones(len(k1), bool), np.ones(len(k1), bool)
    new1[1:] = k1[1:] != k1[:-1]
    new[1:] = new1[1:] | (k2[1:] != k2[:-1])
    g1, g2 = np.cumsum(new1) - 1, np.cumsum(new) - 1
    all1 = np.bincount(g1, weights=counts)[g1]
    all2 = np.bincount(g2, weights=counts)[g2]
    different = np.bincount(g1, weights=new)[g1]
    hot = (np.bincount(g1, weights=counts == 0)[g1] > 0) | (different > HOT_ANCHOR)
    said = np.select([hot, all1 == 1, different == 1, (all2 > 1) & new, all2 > 1], [HOT, ALONE, WHOLE, FIRST, WHOLE], COMPARE).astype(np.uint8)
    back = np.empty(len(said), np.uint8)
    back[order] = said
    return pa.table([bucket.column("chunk"), bucket.column("bucket"), pa.array([squeeze(back[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())], ["chunk", "bucket", "said"])


SPANS, SEGMENT, WINDOWS = range(3)
_FOUND = [("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("anchor", pa.int64()), ("bytes", pa.binary()), ("others", pa.binary()), ("places", pa.binary()), ("off", pa.int32()), ("windows", pa.int32()), ("row", pa.int64()), ("start", pa.int64()), ("wanted", pa.bool_())]
_FOUND_SQL = "chunk int, kind int, bucket int, anchor long, bytes binary, others binary, places binary, off int, windows int, row long, start long, wanted boolean"


def _triples(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> bytes:
    out = np.empty(len(rows), TRIPLE)
    out["row"], out["lo"], out["hi"] = rows, lo, hi
    return squeeze(out)


def _judged(width: int, anchor: int, buckets: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """Spans that are settled, segments to compare, and windows of hot anchors."""
        rows = []
        _, texts = _chunk_rows(chunk) if chunk.num_rows else (None, pa.array([], pa.string()))
        seg, data, _ = _chunk_segments(texts, width, anchor)
        if len(seg["row"]):
            number = chunk.column("chunk")[0].as_py()
            order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
            packed = answers.column("said").to_pylist()
            said = np.concatenate([unsqueeze(packed[i], np.uint8) for i in order])[_entries(seg)[3]]
            sure = np.flatnonzero((said == WHOLE) | (said == FIRST))
            blank = dict.fromkeys(k for k, _ in _FOUND)
            if len(sure):
                rows.append(blank | {"chunk": number, "kind": SPANS, "bytes": _triples(seg["row"][sure], seg["start"][sure], seg["start"][sure] + seg["windows"][sure] - 1 + width)})
            sent: set[tuple[int, int]] = set()
            for i in np.flatnonzero((said == COMPARE) | (said == FIRST)).tolist():
                if said[i] == FIRST:
                    if (k := (int(seg["key1"][i]), int(seg["key2"][i]))) in sent:
                        continue
                    sent.add(k)
                at, windows = int(seg["at"][i]), int(seg["windows"][i])
                rows.append(blank | {"chunk": number, "kind": SEGMENT, "anchor": int(seg["key1"].view(np.int64)[i]), "bytes": data[at : at + windows - 1 + width].tobytes(), "off": int(seg["off"][i]), "windows": windows, "row": int(seg["row"][i]), "start": int(seg["start"][i]), "wanted": bool(said[i] == COMPARE)})
            hot = np.flatnonzero(said == HOT)
            if len(hot):
                hashes, others, places = [], [], []
                for i in hot.tolist():
                    at, windows = int(seg["at"][i]), int(seg["windows"][i])
                    n = windows - 1 + width
                    up, down = powers(n)
                    total = np.zeros(n + 1, U64)
                    np.cumsum(_BYTE_CODE[data[at : at + n]] * up[:n], out=total[1:])
                    hashes.append(_spread((total[width:] - total[:-width]) * down[:windows]))
                    others.append(Sums(data[at : at + n], BYTE_CODES).spans(np.arange(windows), np.arange(width, n + 1)))
                    places.append(np.stack([np.full(windows, seg["row"][i]), seg["start"][i] + np.arange(windows)]))
                h, h2, p = np.concatenate(hashes), np.concatenate(others), np.concatenate(places, axis=1)
                order = np.lexsort((h2, h))
                h, h2, p = h[order], h2[order], p[:, order]
                rows += [blank | {"chunk": number, "kind": WINDOWS, "bucket": b, "bytes": squeeze(h[lo:hi]), "others": squeeze(h2[lo:hi]), "places": squeeze(p[:, lo:hi])} for b, lo, hi in by_bucket(coded(h, buckets))]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in _FOUND], [k for k, _ in _FOUND])

    return run


def repeated_windows(texts: list[bytes], off: np.ndarray, windows: np.ndarray, group: np.ndarray, width: int, most_off: int) -> np.ndarray:
    """flags[i, j]: window j of segment i has an equal one in another segment of its group; groups are in order.

    Column-wise construction over aligned segments, from the last column to the first.
    """
    count = len(texts)
    size = np.array([len(t) for t in texts])
    begin = most_off - off  # the column of the first byte
    end = begin + size
    columns = np.zeros((int(end.max()), count), np.uint8)  # one sequential run of symbols a column
    flat = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(count), size)
    columns[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + begin[owner], owner] = flat
    flags = np.zeros((count, int(windows.max())), bool)
    entering = np.argsort(-end, kind="stable")
    edges = np.searchsorted(-end[entering], -np.arange(len(columns) + 1), "left")
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int32)
    for column in range(len(columns) - 1, -1, -1):
        fresh = entering[edges[column + 1] : edges[column]]
        keep = np.flatnonzero(begin[order] <= column) if len(order) else np.zeros(0, np.int64)
        if len(fresh):  # empty suffixes come before all others of their group
            merged = np.concatenate([fresh, order])
            before = np.concatenate([np.zeros(len(fresh), np.int32), common])
            gone = np.concatenate([np.ones(len(fresh), bool), begin[order] <= column])
            sort = np.argsort(group[merged], kind="stable")
            order, common, keep = merged[sort], before[sort], np.flatnonzero(gone[sort])
        if not len(keep):
            order, common = order[:0], common[:0]
            continue
        inserted = columns[column, order[keep]]  # this round's part of the transform
        step = np.argsort((group[order[keep]] << 8) | inserted, kind="stable")
        at = keep[step]
        new = order[at]
        key = (group[new] << 8) | columns[column, new]
        same = np.zeros(len(new), bool)
        same[1:] = key[1:] == key[:-1]
        longer = np.zeros(len(new), np.int32)
        pairs = np.flatnonzero(same)
        if len(pairs):
            bounds = np.stack([at[pairs - 1] + 1, at[pairs] + 1], axis=1).ravel()
            longer[pairs] = np.minimum.reduceat(np.append(common, 0), bounds)[::2] + 1
        order, common = new, np.minimum(longer, width)
        met = common >= width
        if met.any():
            met[:-1] |= met[1:]
            hit = order[met]
            flags[hit, column - begin[hit]] = True
    return flags


def _compare(width: int, anchor: int):
    def spans(rows: list[dict]) -> pa.RecordBatch | None:
        group = np.unique(np.array([r["anchor"] for r in rows]), return_inverse=True)[1].astype(np.int64)
        windows = np.array([r["windows"] for r in rows])
        flags = repeated_windows([r["bytes"] for r in rows], np.array([r["off"] for r in rows]), windows, group, width, width - anchor)
        flags &= np.array([r["wanted"] for r in rows])[:, None]
        side = np.zeros((len(rows), 1), bool)
        turn = np.diff(np.concatenate([side, flags, side], axis=1).astype(np.int8), axis=1)
        i, lo = np.nonzero(turn == 1)
        hi = np.nonzero(turn == -1)[1]
        if not len(i):
            return None
        start = np.array([r["start"] for r in rows])[i]
        chunk = np.array([r["chunk"] for r in rows])[i]
        row = np.array([r["row"] for r in rows])[i]
        out = [(int(c), _triples(row[m], (start + lo)[m], (start + hi)[m] - 1 + width)) for c in np.unique(chunk) for m in [chunk == c]]
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], ["chunk", "spans"])

    def run(batches):
        held: list[dict] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if size > BATCH_BYTES and r["anchor"] != held[-1]["anchor"]:
                    if (found := spans(held)) is not None:
                        yield found
                    held, size = [], 0
                held.append(r)
                size += len(r["bytes"])
        if held and (found := spans(held)) is not None:
            yield found

    return run


def _hot_spans(windows: DataFrame, width: int, chunks: int, buckets: int) -> DataFrame:
    """(chunk, spans) of the windows of hot anchors that occur twice or more; chunks and buckets: tasks of either."""

    def new(h: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return np.append(np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (h2[1:] != h2[:-1]))

    def counted(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                h, h2 = unsqueeze(r["bytes"], U64), unsqueeze(r["others"], U64)
                heads = np.flatnonzero(new(h, h2))
                rows.append((r["chunk"], r["bucket"], squeeze(h[heads]), squeeze(h2[heads]), squeeze(np.diff(np.append(heads, len(h))).astype(np.uint32))))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["chunk", "bucket", "hashes", "others", "counts"])

    def answer(bucket: pa.Table) -> pa.Table:
        each = [unsqueeze(x, U64) for x in bucket.column("hashes").to_pylist()]
        h, h2 = np.concatenate(each), np.concatenate([unsqueeze(x, U64) for x in bucket.column("others").to_pylist()])
        counts = np.concatenate([unsqueeze(x, np.uint32) for x in bucket.column("counts").to_pylist()])
        order = np.lexsort((h2, h))
        group = np.cumsum(new(h[order], h2[order])) - 1
        many = np.empty(len(h), bool)
        many[order] = (np.bincount(group, weights=counts[order]) > 1)[group]
        cuts = np.cumsum([0, *map(len, each)])
        return pa.table([bucket.column("chunk"), bucket.column("bucket"), pa.array([squeeze(many[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())], ["chunk", "bucket", "many"])

    def spans(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                places = unsqueeze(r["places"], np.int64).reshape(2, -1)
                many = unsqueeze(r["many"], np.bool_)[np.cumsum(new(unsqueeze(r["bytes"], U64), unsqueeze(r["others"], U64))) - 1]
                row, start = places[:, many]
                if len(row):
                    rows.append((r["chunk"], _triples(row, start, start + width)))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["chunk", "spans"])

    own = windows.select("chunk", "bucket", "bytes", "others", "places")
    replies = own.select("chunk", "bucket", "bytes", "others").mapInArrow(counted, "chunk int, bucket int, hashes binary, others binary, counts binary").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, many binary")
    return own.repartition(chunks, "chunk", "bucket").join(replies, ["chunk", "bucket"]).select("chunk", "bytes", "others", "places", "many").mapInArrow(spans, "chunk int, spans binary")


def _cut(keep_text: bool):
    def run(chunk: pa.Table, spans: pa.Table) -> pa.Table:
        """Each document with its maximal removed runs, and what is left of it."""
        ids, texts = _chunk_rows(chunk) if chunk.num_rows else ([], pa.array([], pa.string()))
        data, offsets = byte_view(texts)
        found = np.concatenate([np.zeros(0, TRIPLE), *(unsqueeze(x, TRIPLE) for x in spans.column("spans").to_pylist())])
        found = found[np.lexsort((found["lo"], found["row"]))]
        bounds = np.searchsorted(found["row"], np.arange(len(ids) + 1))
        runs, kept = [], []
        for i in range(len(ids)):
            own, text = found[bounds[i] : bounds[i + 1]], data[offsets[i] : offsets[i + 1]]
            merged: list[dict] = []
            if len(own):
                reach = np.maximum.accumulate(own["hi"])
                first = np.append(True, own["lo"][1:] > reach[:-1])
                heads = np.flatnonzero(first)
                merged = [{"start": int(a), "end": int(b)} for a, b in zip(own["lo"][heads], reach[np.append(heads[1:], len(own)) - 1])]
                stay = np.ones(len(text), bool)
                for m in merged:
                    stay[m["start"] : m["end"]] = False
                text = text[stay]
            runs.append(merged)
            kept.append(text.tobytes() if keep_text else None)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), pa.array(runs, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, anchor: int = ANCHOR, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, removed: array of maximal [start, end) runs of bytes, kept: the other bytes) of every row; see the module's text."""
    size = docs.agg(F.sum(text_bytes(text_col)).alias("bytes")).first()["bytes"]
    chunks, buckets = parts(size, grown(chunk_bytes, size, GROWN_FROM)), parts(size, grown(bucket_bytes, size, GROWN_FROM))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int")).repartition(tasks(docs.sparkSession, chunks), "chunk")

    def send(chunk: pa.Table) -> pa.Table:
        _, own = _chunk_rows(chunk)
        key1, key2, counts, _ = _entries(_chunk_segments(own, width, anchor)[0])
        rows = [(chunk.column("chunk")[0].as_py(), b, squeeze(key1[lo:hi]), squeeze(key2[lo:hi]), squeeze(counts[lo:hi])) for b, lo, hi in by_bucket(coded(key1, buckets))]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["chunk", "bucket", "key1", "key2", "counts"])

    sent = texts.groupBy("chunk").applyInArrow(send, "chunk int, bucket int, key1 binary, key2 binary, counts binary")
    chunk_tasks, bucket_tasks = (tasks(docs.sparkSession, n) for n in (chunks, buckets))
    replies = sent.repartition(bucket_tasks, "bucket").groupBy("bucket").applyInArrow(_verdicts, "chunk int, bucket int, said binary")
    found = stored(texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_judged(width, anchor, buckets), _FOUND_SQL), "segments")
    compared = found.where(F.col("kind") == SEGMENT).select("anchor", "bytes", "off", "windows", "chunk", "row", "start", "wanted").repartition(chunk_tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare(width, anchor), "chunk int, spans binary")
    spans = found.where(F.col("kind") == SPANS).select("chunk", F.col("bytes").alias("spans")).unionByName(compared)
    hot = found.where(F.col("kind") == WINDOWS)
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(hot, width, chunk_tasks, bucket_tasks))
    return texts.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(_cut(keep_text), "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
