"""SentencePiece encoding and decoding by way of a table of distinct chunks.

Where no piece of a vocabulary has a white space marker after another character, segments
never cross the place before a run of markers.  A text is cut there, and the marked words
that come out are segmented each on its own, so each distinct one is segmented only once.
Which models allow that is checked when one is loaded; others are refused: byte pair
encoding, no normalisation, a marker put before the text, spaces kept, pieces as said.

How: one pass over the texts writes them dictionary-encoded.  A task gathers its texts in
chunks of about `CHUNK_BYTES`; a chunk has a dictionary of its marked words and, in a file of
the shared folder, the positions of its documents' words.  A chunk sends the words of each bucket of the hash
space in one packed message; a bucket's task makes the table of distinct words (found by
hash, compared by bytes), has the library segment each once, and answers with ids by
position, and the task that gets a chunk's answers joins them back to its documents.  Decoding is the library's, over
all ids of a document.

Scale: texts are read once and not shuffled; what moves are chunks' distinct words and their
ids.  A word of every chunk is one entry a chunk.  Chunks and buckets grow with the
square root of the corpus beyond `GROWN_FROM` bytes, so that messages grow with the corpus.
A chunk is bounded, but for one longer text.  Files are named by chance, and what a lost
executor had begun isn't in the written table.

Null and empty texts have no ids and decode to the empty text.  Texts of spaces alone, words
of any length and characters outside the vocabulary (ids of bytes) give the library's ids.
Repeated rows and null ids are documents like others.  Further columns are not looked at.
An empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .kernel import BYTE_CODES, Grown, HeldSpans, byte_view, distinct_spans, flat_places, slices
from .packing import pack, planes, squeeze, unpack, unplanes, unsqueeze
from .shared import fresh_path, grown, parts, stored, table, tasks, text_bytes

CHUNK_BYTES = 16 << 20
BUCKET_BYTES, GROWN_FROM = 16 << 20, 32 << 30  # bytes of all texts whose words come into one bucket
MOST_WORDS, MOST_BYTES = 2_000_000, 64 << 20  # words that a bucket's task holds, and their bytes
MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=1)
def processor(path: str):
    """The library's processor of a model whose segments never cross the place before a run of markers; the worker's own."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    held = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto.FromString(held.serialized_model_proto())
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
    kinds = proto.SentencePiece
    whole = trained.model_type == trained.BPE and not trained.treat_whitespace_as_suffix and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)
    if not plain or not whole or held.is_unknown(held.piece_to_id(MARK)) or any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces):
        raise ValueError("segments of this model may cross white space markers")
    return held


def marked_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, how many of each document) of the marked words of data[offsets[0]:offsets[-1]], from offsets[0] on.

    The one marker that every word begins with (put before the text in case of the first) is left out.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw, local = data[lo:hi], offsets - lo
    n = len(raw)
    wide = np.zeros(n, bool)
    wide[: max(0, n - 2)] = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81) if n > 2 else False
    size = (raw == 0x20) + 3 * wide  # bytes of the marker that starts here
    after = np.zeros(n + 3, bool)  # a marker ends before
    after[1 : n + 1] |= raw == 0x20
    after[3:] |= wide
    cut = np.append((size > 0) & ~after[:n], False)
    cut[local] = False
    heads = local[:-1][np.diff(local) > 0]
    cut[heads] = True
    begin = np.flatnonzero(cut)
    skip = size[begin]
    skip[np.searchsorted(begin, heads)] = 0
    return begin + skip, np.append(begin[1:], n), np.diff(np.searchsorted(begin, local))


_COLUMNS = [("chunk", "long", pa.int64()), ("bucket", "int", pa.int32()), ("positions", "binary", pa.binary()), ("sizes", "binary", pa.binary()), ("words", "binary", pa.binary()), ("uri", "string", pa.string())]


_SLICE = pa.schema([("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("positions", pa.binary())])


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, _, t in _COLUMNS], [c for c, *_ in _COLUMNS])


class _Chunk:
    """Texts as positions in a dictionary of their marked words."""

    def __init__(self):
        self.number, self.words, self.keys, self.slices, self.size = uuid.uuid4().int >> 65, HeldSpans(), Grown(np.uint64), [], 0

    def add(self, doc_ids: list, data: np.ndarray, offsets: np.ndarray) -> None:
        raw = data[int(offsets[0]) : int(offsets[-1])]
        starts, ends, counts = marked_words(data, offsets)
        keys, first, at = distinct_spans(raw, starts, ends, BYTE_CODES)
        begin, long = starts[first], (ends - starts)[first]
        place = self.words.find(keys, raw, begin, long)
        for missing, findable in ((place == -1, True), (place == -2, False)):
            place[missing] = self.words.add(keys[missing], raw, begin[missing], long[missing], findable)
            self.keys.append(keys[missing])
        self.slices.append((doc_ids, counts.astype(np.int32), place[at].astype(np.uint32)))
        self.size += len(raw)

    def rows(self, buckets: int, folder: str):
        """A row that names the file of the chunk's documents, then one for each bucket of words.  Frequent words get small positions."""
        n, words = len(self.words), self.words
        often = sum((np.bincount(x, minlength=n) for *_, x in self.slices), np.zeros(n, np.int64))
        order = np.argsort(-often, kind="stable")
        position = np.empty(n, np.uint32)
        position[order] = np.arange(n)
        out, uri = pa.BufferOutputStream(), f"{folder}/chunk-{self.number:016x}.arrow"
        with pa.ipc.new_stream(out, _SLICE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
            for doc_ids, counts, at in self.slices:
                to.write_batch(pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((doc_ids, counts, planes(position[at])), _SLICE)], schema=_SLICE))
        if self.slices:
            files.put(uri, out.getvalue().to_pybytes())
            yield _row(chunk=self.number, uri=uri)
        bucket = (self.keys.data[:n] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((position, bucket))
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            mine = order[cuts[b] : cuts[b + 1]]
            size = words.sizes.data[mine]
            yield _row(chunk=self.number, bucket=b, positions=pack(position[mine]), sizes=planes(size), words=squeeze(words.bytes.data[flat_places(words.starts.data[mine], size)]))


def _dictionary_encoded(docs: DataFrame, chunk_bytes: int, buckets: int) -> DataFrame:
    """The rows of all chunks, written.  Files of chunks are named by chance, and those of lost attempts are in no row."""
    folder = fresh_path(docs.sparkSession, "piece-files")

    def run(batches):
        chunk = _Chunk()
        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            for lo, hi in slices(offsets):
                chunk.add(batch.column(0)[lo:hi].to_pylist(), data, offsets[lo : hi + 1])
                if chunk.size >= chunk_bytes:
                    yield from chunk.rows(buckets, folder)
                    chunk = _Chunk()
        yield from chunk.rows(buckets, folder)

    return stored(docs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t, _ in _COLUMNS)), "piece-chunks")


def segmented(words: DataFrame, model: str) -> DataFrame:
    """(chunk, positions, sizes, ids) of the words of chunks' buckets, dealt by bucket; each distinct word is segmented once as long as it is held."""

    def run(batches):
        library = processor(model)
        lone = [library.piece_to_id(MARK)]  # the word that is a marker alone
        held, starts, sizes, ids = HeldSpans(), Grown(np.int64), Grown(np.int64), Grown(np.uint32)
        for batch in batches:
            for chunk, positions, long, text in zip(*(batch.column(c).to_pylist() for c in ("chunk", "positions", "sizes", "words"))):
                raw, size = unsqueeze(text, np.uint8), unplanes(long).astype(np.int64)
                begin = np.cumsum(size) - size
                keys, first, at = distinct_spans(raw, begin, begin + size, BYTE_CODES)
                if len(held) > MOST_WORDS or held.bytes.n > MOST_BYTES:
                    held, starts, sizes, ids = HeldSpans(), Grown(np.int64), Grown(np.int64), Grown(np.uint32)
                place = held.find(keys, raw, begin[first], size[first])
                for missing, findable in ((np.flatnonzero(place == -1), True), (np.flatnonzero(place == -2), False)):
                    if len(missing):
                        buf = raw.tobytes()
                        each = [buf[begin[i] : begin[i] + size[i]].decode() for i in first[missing].tolist()]
                        found = [x if w else lone for w, x in zip(each, library.encode(each, num_threads=1))]
                        place[missing] = held.add(keys[missing], raw, begin[first[missing]], size[first[missing]], findable)
                        many = np.fromiter(map(len, found), np.int64, len(found))
                        starts.append(ids.n + np.cumsum(many) - many)
                        sizes.append(many)
                        ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(many.sum())))
                entry = place[at]
                many = sizes.data[entry]
                out = (chunk, pa.int64()), (positions, pa.binary()), (planes(many), pa.binary()), (planes(ids.data[flat_places(starts.data[entry], many)]), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in out], ["chunk", "positions", "sizes", "ids"])

    return words.mapInArrow(run, "chunk long, positions binary, sizes binary, ids binary")


def _texts(ids: pa.ListArray, model: str) -> pa.Array:
    """The library's text of each row's ids, a row at a time."""
    held, flat, bounds = processor(model), ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return pa.array((held.decode(flat[lo:hi].tolist()) if lo < hi else "" for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())), pa.string())


def _joined(chunk: pa.Table, dictionary: pa.Table, model: str | None = None) -> pa.Table:
    """(doc_id, ids) of a chunk's documents; with a model, also their decoded texts."""
    column = lambda c, read: np.concatenate([np.zeros(0, np.int64), *(read(x).astype(np.int64) for x in dictionary.column(c).to_pylist())])
    order = np.argsort(column("positions", unpack))
    size, flat, out = column("sizes", unplanes), column("ids", unplanes).astype(np.int32), []
    begin = (np.cumsum(size) - size)[order]
    size = size[order]
    slices_ = (b for uri in chunk.column("uri").to_pylist() for b in pa.ipc.open_stream(files.get(uri)))
    for doc_ids, counts, positions in ((b.column(k)[0] for k in range(3)) for b in slices_):
        at = unplanes(positions.as_py())
        words = np.append(0, np.cumsum(counts.values.to_numpy(), dtype=np.int64))
        ends = np.append(0, np.cumsum(size[at]))[words].astype(np.int32)
        columns = {"doc_id": doc_ids.values, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[flat_places(begin[at], size[at])], pa.int32()))}
        out.append(pa.RecordBatch.from_pydict(columns | ({"text": _texts(columns["ids"], model)} if model else {})))
    return pa.Table.from_batches(out, None if out else pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())][: 3 if model else 2]))


def encoded(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, decode: bool = False) -> DataFrame:
    """(doc_id, ids: array of int) of every row of docs, and with decode the text of the ids; model: path of a sentencepiece file that tasks can read."""
    model = model or default_model()
    processor(model)
    spark, own = docs.sparkSession, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = own.agg(F.sum(text_bytes())).first()[0]
    buckets = parts(size, grown(bucket_bytes, size, GROWN_FROM))
    chunks = _dictionary_encoded(own, grown(chunk_bytes, size, GROWN_FROM), buckets)
    words = chunks.where("bucket is not null").select("chunk", "bucket", "positions", "sizes", "words").repartition(tasks(spark, buckets), "bucket").drop("bucket")
    texts = chunks.where("uri is not null").select(F.col("chunk").alias("held_in"), "uri")

    def joined(chunk: pa.Table, dictionary: pa.Table) -> pa.Table:
        return _joined(chunk, dictionary, model if decode else None)

    return texts.groupBy("held_in").cogroup(segmented(words, model).groupBy("chunk")).applyInArrow(joined, "doc_id long, ids array<int>" + ", text string" * decode)


def decoded(ids: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of ids (doc_id, ids) with the library's text of each."""
    model = model or default_model()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(batch.column(1), model)], ["doc_id", "ids", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encoded(table(spark, sf_dir, "documents"), decode=True)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
