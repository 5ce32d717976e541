"""Token ids in binary shards, compressed by Re-Pair, with random access to documents.

Documents are dealt to shards in ascending id order (nulls first).  A shard's ids are
compressed by Re-Pair: the frequent pairs of neighbouring ids are replaced by new ids
(nonterminals), round after round until no pair is there `least` times.  A round takes all
frequent pairs, the most frequent first where they overlap; pairs never reach over a
document's end.  Rules are stored with the lengths of their expansions, and documents with
their places in the compressed sequence, which is cut into frames: one document, or any
span of ids, is decoded from its own frames and rules alone.

File format: `RPT2`, then the header (little-endian unsigned 64-bit: documents, ids, rules,
first nonterminal, length of the sequence, symbols of a frame, and the sizes of the
sections), then the sections, each a zstd frame: rules (two unsigned 32-bit each), rules of
each round, lengths of expansions, null flags and doc ids, ids before each document, place
of each document in the sequence, where each frame starts; then the sequence (unsigned
32-bit), a zstd frame each `FRAME` symbols.

Scale: one range shuffle of the texts by id (rows of one id by their texts' beginnings, so that an id with many texts is many ranges), with
as many tasks as the texts' bytes ask; a task streams through its range and writes
shards of about `shard_ids` ids.  The list of shards, one row each, is a table; running sums
over the writing tasks, and over each one's shards, give the ids before each shard.  A task
reads shards of about `READ_IDS` ids.  Files are named by attempt and only those in the list
are read, so a lost executor leaves nothing wrong.

Tokenising: a text is cut before single spaces between characters that can't be white
space, and between an ASCII letter and punctuation, where a byte-level pre-tokeniser of this
kind always starts a new word, and each
different piece of a batch is encoded once by the tokenizers library.  An added token's
string in a text is one piece and gives that token's id, as an untouched tokenizer does;
with added_tokens=False it is ordinary text.

Null texts are empty documents: they hold only the end id.  Repeated ids stay together,
one document a row, ordered by text.  A very long text is encoded whole, in
memory in proportion to it, and makes its shard longer.  An empty table gives no files and
no rows.  Further columns are not looked at.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .kernel import Grown, HeldSpans, byte_view, distinct_spans, flat_places, release, slices
from .shared import fresh_path, parts, stored, table, tasks, text_bytes

END_ID = 2
SHARD_IDS, READ_IDS = 1 << 19, 32 << 20  # ids of a shard, and of the shards that one task reads
ENCODE_BYTES = 1 << 19  # of text, that are encoded at once
TASK_BYTES = 128 << 20  # of text, in a range of ids that one task writes
KEY_CHARS = 64  # of a text, that ranges of one id go by
LEAST_COUNT = 32
FRAME, INDEX_READ = 1 << 13, 1 << 17  # symbols of a frame of the sequence; bytes of the first read, which mostly holds the index
MOST_PIECES, MOST_BYTES = 1_500_000, 64 << 20  # pieces that a worker holds, and their bytes
LONG_PIECE = 1024  # bytes; longer ones are encoded where they occur and not held
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_SAFE_NEXT = np.ones(256, bool)
_SAFE_NEXT[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False
_SAFE_LAST = np.ones(256, bool)
_SAFE_LAST[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = False


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 as it is, others from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = np.array([ord(x) for _, x in sorted(_byte_letters().items())], "<u2")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Pieces:
    """Encodes texts piece by piece, each different piece once as long as it is held."""

    def __init__(self, path: str, added_tokens: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel units
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens  # special tokens' strings in a text are then ordinary text
        added = self.tokenizer.get_added_tokens_decoder().values() if added_tokens else []
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that depend on what is beside them")
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in sorted(added, key=lambda t: -len(t.content)))) if added else None
        self.first_new = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if self.first_new > 1 << 16:
            raise ValueError("token ids of more than 16 bits")
        self._forget()

    def _forget(self) -> None:
        self.held, self.ids, self.starts, self.sizes = HeldSpans(), Grown(np.uint16), Grown(np.int32), Grown(np.int32)

    def _encoded(self, pieces: list[bytes], words: list[str]) -> list[list[int]]:
        """Ids of pieces, which are given as the vocabulary writes them too; one of letters after a space at most is one word to the model."""
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(w)] if (q := p[1:] if p[:1] == b" " else p).isalpha() or not q.isascii() and q.decode().isalpha() else None for p, w in zip(pieces, words)]
        odd = [i for i, x in enumerate(ids) if x is None]
        for i, got in zip(odd, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in odd], add_special_tokens=False)):
            ids[i] = got.ids
        return ids

    def _added_spans(self, raw: np.ndarray, local: np.ndarray) -> list[tuple[int, int]]:
        """Where strings of added tokens stand, each in one document."""
        found, buf, at = [], raw.tobytes() if self.added else b"", 0
        while self.added and (m := self.added.search(buf, at)):
            lo, hi = m.span()
            within = hi <= local[np.searchsorted(local, lo, "right")]
            found += [(lo, hi)] if within else []
            at = hi if within else lo + 1
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each document) of data[offsets[0]:offsets[-1]]."""
        lo, hi = int(offsets[0]), int(offsets[-1])
        raw, local = data[lo:hi], offsets - lo
        n = len(raw)
        cut = np.zeros(n + 1, bool)
        if n > 2:
            inner = (raw[1:-1] == 0x20) & _SAFE_NEXT[raw[2:]] & _SAFE_LAST[raw[:-2]]
            wide = raw[:-2] >= 0x80  # the last character may be white space of two or three bytes
            if wide.any():
                back1, back2 = np.append(np.uint8(0), raw[:-3]), np.concatenate([np.zeros(2, np.uint8), raw[:-4]])[: n - 2]
                inner &= ~(wide & ((back1 == 0xC2) | np.isin(back2, (0xE1, 0xE2, 0xE3))))
            cut[1 : n - 1] = inner | (_LETTER[raw[:-2]] & _MARK[raw[1:-1]])
        cut[local] = True
        for lo, hi in self._added_spans(raw, local):
            cut[lo], cut[lo + 1 : hi], cut[hi] = True, False, True
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n)
        known, first, at = distinct_spans(raw, starts, ends)
        if len(self.held) > MOST_PIECES or self.held.bytes.n > MOST_BYTES:
            self._forget()
        size = (ends - starts)[first]
        place = self.held.find(known, raw, starts[first], size)
        new, old = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        many = np.zeros(len(known), np.int64)
        many[old] = self.sizes.data[place[old]]
        made = np.zeros(0, np.uint16)
        if len(new):
            buf, letters = raw.tobytes(), _BYTE_LETTERS[raw].tobytes().decode("utf-16-le")
            spans = [*zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            found = self._encoded([buf[a:b] for a, b in spans], [letters[a:b] for a, b in spans])
            many[new] = np.fromiter(map(len, found), np.int64, len(found))
            made = np.fromiter(chain.from_iterable(found), np.uint16, int(many[new].sum()))
        is_new = np.repeat(place < 0, many)
        ids = np.empty(len(is_new), np.uint16)
        ids[is_new], ids[~is_new] = made, self.ids.data[flat_places(self.starts.data[place[old]], many[old])]
        begin = np.cumsum(many) - many
        keep = new[(place[new] == -1) & (size[new] <= LONG_PIECE)]
        self.held.add(known[keep], raw, starts[first[keep]], size[keep])
        self.starts.append(self.ids.n + np.cumsum(many[keep]) - many[keep])
        self.sizes.append(many[keep])
        self.ids.append(ids[flat_places(begin[keep], many[keep])])
        before = np.append(0, np.cumsum(many[at], dtype=np.int64))
        return ids[flat_places(begin[at], many[at])], np.diff(before[np.searchsorted(starts, local)])


@lru_cache(maxsize=1)
def _pieces(tokenizer: str, added_tokens: bool = True) -> Pieces:
    """The worker's own, kept from task to task."""
    return Pieces(tokenizer, added_tokens)


_SLOT_BITS = 20


def _places(known: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Where each pair would be in sorted known ones: by a table of hash slots, and by bisection where slots clash."""
    if len(pairs) < 1 << 16:
        return np.searchsorted(known, pairs)
    slots = lambda x: ((x * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    held = np.full(1 << _SLOT_BITS, len(known), np.int32)
    held[slots(known)] = np.arange(len(known))
    at = held[slots(pairs)]
    wrong = np.flatnonzero(np.append(known, known[:1])[at] != pairs)
    wrong = wrong[at[wrong] < len(known)]
    at[wrong] = np.searchsorted(known, pairs[wrong])
    return at


def _frequent(seq: np.ndarray, after: np.ndarray, active: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of active whose pair is there `least` times, its rank by count, the ranked pairs)."""
    pair = (seq[active].astype(np.uint64) << np.uint64(32)) | seq[after[active]]
    ordered = np.sort(pair)
    heads = np.flatnonzero(np.append(np.ones(min(1, len(pair)), bool), ordered[1:] != ordered[:-1]))
    count = np.diff(np.append(heads, len(pair)))
    often, count = ordered[heads[count >= least]], count[count >= least]
    if not len(often):
        return active[:0], np.zeros(0, np.int64), often
    at = _places(often, pair)
    at[at == len(often)] = 0
    keep = often[at] == pair
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(often), np.int64)
    rank[order] = np.arange(len(often))
    return active[keep], rank[at[keep]], often[order]


def re_pair(ids: np.ndarray, end_id: int, first_new: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, rules, rules of each round): rule k rewrites first_new + k to its two ids.  Ends when no pair is there `least` times.

    Replaced neighbours are skipped by links, and a round counts only the places that the last one changed or
    left over: other pairs were too rare before, and only get rarer.
    """
    seq, rules = ids.astype(np.uint32), []
    after, before = np.arange(1, len(seq) + 2), np.arange(-1, len(seq))
    alive, total = np.ones(len(seq), bool), 0
    active = np.flatnonzero((seq[:-1] != end_id) & (seq[1:] != end_id))
    while True:
        active, mine, pairs = _frequent(seq, after, active, least)
        if not len(active):
            break
        beside = after[active[:-1]] == active[1:]
        yields = np.append(False, beside & (mine[:-1] < mine[1:])) | np.append(beside & (mine[1:] < mine[:-1]), False)
        head = np.append(True, ~(beside & (mine[:-1] == mine[1:])))  # a pair that overlaps itself, in a stretch of one id: every other place
        yields |= (np.arange(len(active)) - np.maximum.accumulate(np.where(head, np.arange(len(active)), 0))) % 2 == 1
        at, ranks = active[~yields], mine[~yields]
        used = np.flatnonzero(np.bincount(ranks, minlength=len(pairs)))
        number = np.zeros(len(pairs), np.uint32)
        number[used] = first_new + total + np.arange(len(used))
        rules.append(pairs[used])
        seq[at] = number[ranks]
        second = after[at]
        alive[second] = False
        after[at] = after[second]
        before[after[at]] = at
        left = active[yields]
        left = left[alive[left]]
        near = np.sort(np.concatenate([left[seq[left] < first_new + total], at, before[at]]))
        total += len(used)
        active = near[np.append(near[:1] >= 0, (near[1:] != near[:-1]) & (near[1:] >= 0))]
        active = active[after[active] < len(seq)]
        active = active[(seq[active] != end_id) & (seq[after[active]] != end_id)]
    pairs = np.concatenate([np.zeros(0, np.uint64), *rules])
    return seq[alive], np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32), np.array([len(r) for r in rules], np.uint32)


def rule_lengths(rules: np.ndarray, rounds: np.ndarray, first_new: int) -> np.ndarray:
    """How many ids each rule stands for; a round's rules are made of earlier ones."""
    lengths = np.ones(first_new + len(rules), np.uint32)
    at = first_new
    for n in rounds.tolist():
        lengths[at : at + n] = lengths[rules[at - first_new : at - first_new + n]].sum(axis=1)
        at += n
    return lengths[first_new:]


def expansions(rules: np.ndarray, rounds: np.ndarray, lengths: np.ndarray, first_new: int) -> tuple[np.ndarray, np.ndarray]:
    """(all expansions one after another, where each starts)."""
    size = lengths.astype(np.int64)
    starts = np.cumsum(size) - size
    flat, at = np.zeros(int(size.sum()), np.uint32), 0
    for n in rounds.tolist():
        parts_ = rules[at : at + n].ravel()
        plain = parts_ < first_new
        rule = np.where(plain, 0, parts_ - np.uint32(first_new)).astype(np.int64)
        many = np.where(plain, 1, size[rule])
        where = np.repeat(np.where(plain, 0, starts[rule]) - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        made = flat[where]
        made[np.repeat(plain, many)] = parts_[plain]
        flat[starts[at] : starts[at] + len(made)] = made
        at += n
    return flat, starts


def expand(seq: np.ndarray, rules: np.ndarray, rounds: np.ndarray, lengths: np.ndarray, first_new: int) -> np.ndarray:
    """All ids of a sequence, by way of all rules' expansions."""
    if not len(rules):
        return seq
    flat, starts = expansions(rules, rounds, lengths, first_new)
    plain = seq < first_new
    rule = np.where(plain, 0, seq - np.uint32(first_new)).astype(np.int64)
    size = np.where(plain, 1, lengths[rule]).astype(np.int64)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out = flat[np.repeat(np.where(plain, 0, starts[rule]), size) + within]
    out[np.repeat(plain, size)] = seq[plain]
    return out


def expand_few(seq: np.ndarray, rules: np.ndarray, first_new: int) -> np.ndarray:
    """All ids of a short sequence, looking at no other rules than those in it."""
    while (new := seq >= first_new).any():
        last = np.cumsum(1 + new) - 1
        out = np.repeat(seq, 1 + new)
        pairs = rules[(seq[new] - np.uint32(first_new)).astype(np.int64)]
        out[last[new] - 1], out[last[new]] = pairs[:, 0], pairs[:, 1]
        seq = out
    return seq


_HEAD = 13


def shard_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray, end_id: int, first_new: int, frame: int = FRAME, **how) -> bytes:
    seq, rules, rounds = re_pair(ids, end_id, first_new, **how)
    lengths = rule_lengths(rules, rounds, first_new)
    places = np.append(0, np.flatnonzero(seq == end_id) + 1)  # every document ends with the end id, in no rule
    ends = np.cumsum(counts)
    # the end id may also occur inside a document: places are of those ends that are documents' last ids
    if len(places) != len(counts) + 1:
        size = np.ones(len(seq), np.int64)
        new = seq >= first_new
        size[new] = lengths[seq[new] - first_new]
        places = np.append(0, np.searchsorted(np.cumsum(size), ends) + 1)
    blank = np.array([d is None for d in doc_ids], np.uint8).tobytes()
    known = np.array([d or 0 for d in doc_ids], np.int64).tobytes()
    frames = [zstandard.compress(seq[k : k + frame].astype("<u4").tobytes(), 3) for k in range(0, len(seq), frame)]
    index = np.append(0, np.cumsum([len(f) for f in frames], dtype=np.uint64)).astype(np.uint64)
    sections = [zstandard.compress(x.tobytes() if isinstance(x, np.ndarray) else x, 3) for x in (rules, rounds, lengths, blank + known, (ends - counts).astype(np.uint64), places.astype(np.uint64), index)]
    head = np.array([len(doc_ids), len(ids), len(rules), first_new, len(seq), frame, *map(len, sections)], np.uint64)
    return b"RPT2" + head.tobytes() + b"".join(sections) + b"".join(frames)


class Shard:
    """Random access to the documents of one shard: the index is read at once, of the sequence what is asked for.

    source: the file's bytes, or its uri.
    """

    def __init__(self, source: bytes | str):
        self._read = (lambda at, n: source[at : at + n]) if isinstance(source, bytes) else (lambda at, n: files.get(source, at, n))
        start = self._read(0, INDEX_READ)
        if start[:4] != b"RPT2":
            raise ValueError("not a shard of token ids")
        head = np.frombuffer(start, np.uint64, _HEAD, 4).astype(np.int64)
        self.docs, self.total, _, self.first_new, _, self.frame = head[:6].tolist()
        at = 4 + 8 * _HEAD
        self._base = at + int(head[6:].sum())
        start = start if len(start) >= self._base else start + self._read(len(start), self._base - len(start))
        parts_ = []
        for n in head[6:].tolist():
            parts_.append(zstandard.decompress(start[at : at + n]))
            at += n
        whole = lambda k: np.frombuffer(parts_[k], np.uint64).astype(np.int64)
        self.rules, self.rounds, self.lengths = np.frombuffer(parts_[0], np.uint32).reshape(-1, 2), np.frombuffer(parts_[1], np.uint32), np.frombuffer(parts_[2], np.uint32)
        blank, known = np.frombuffer(parts_[3], np.uint8, self.docs), np.frombuffer(parts_[3], np.int64, self.docs, self.docs)
        self.doc_ids = [None if b else int(k) for b, k in zip(blank, known)]
        self.before, self.places, self._frames = whole(4), whole(5), whole(6)

    def _sequence(self, lo: int, hi: int) -> np.ndarray:
        """Symbols lo to hi of the compressed sequence; only their frames are read."""
        if lo >= hi:
            return np.zeros(0, np.uint32)
        first, last = lo // self.frame, -(-hi // self.frame)
        base = int(self._frames[first])
        data = self._read(self._base + base, int(self._frames[last]) - base)
        cuts = (self._frames[first : last + 1] - base).tolist()
        seq = np.frombuffer(b"".join(zstandard.decompress(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])), "<u4")
        return seq[lo - first * self.frame : hi - first * self.frame]

    def document(self, k: int) -> np.ndarray:
        """The ids of document k of the shard, decoded alone."""
        return expand_few(self._sequence(int(self.places[k]), int(self.places[k + 1])), self.rules, self.first_new)

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard; the lengths of expansions say which symbols hold them."""
        start, stop = max(0, start), min(stop, self.total)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = (int(np.searchsorted(self.before, x, "right")) - 1 for x in (start, stop - 1))
        seq = self._sequence(int(self.places[first]), int(self.places[last + 1]))
        size = np.ones(len(seq), np.int64)
        new = seq >= self.first_new
        size[new] = self.lengths[(seq[new] - np.uint32(self.first_new)).astype(np.int64)]
        ends = int(self.before[first]) + np.cumsum(size)
        lo, hi = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        base = int(ends[lo] - size[lo])
        return expand_few(seq[lo:hi], self.rules, self.first_new)[start - base : stop - base]

    def all_ids(self) -> np.ndarray:
        return expand(self._sequence(0, int(self.places[-1])), self.rules, self.rounds, self.lengths, self.first_new)


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS, added_tokens: bool = True) -> DataFrame:
    """Write the documents' ids as shard files under path; the list of shards (uri, first_doc, last_doc, docs, ids, part, number), in order of (part, number)."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        release()
        pieces, part, attempt, number = _pieces(tokenizer, added_tokens), TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0
        names: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def shard():
            uri = f"{path}/ids-{part:06d}-{number:05d}-{attempt}.rpt"
            data, count = np.concatenate(ids), np.concatenate(counts)
            files.put(uri, shard_bytes(names, count, data, end_id, pieces.first_new))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((uri, pa.string()), (names[0], pa.int64()), (names[-1], pa.int64()), (len(names), pa.int64()), (len(data), pa.int64()), (part, pa.int32()), (number, pa.int32()))], ["uri", "first_doc", "last_doc", "docs", "ids", "part", "number"])

        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            for lo, hi in slices(offsets, ENCODE_BYTES):
                got, n = pieces.encode(data, offsets[lo : hi + 1])
                names += batch.column(0)[lo:hi].to_pylist()
                counts.append(n + 1)
                ids.append(np.insert(got, np.cumsum(n), end_id).astype(np.uint32))
                if sum(map(len, ids)) >= shard_ids:
                    yield shard()
                    names, counts, ids, number = [], [], [], number + 1
        if names:
            yield shard()
        names, counts, ids = [], [], []
        release()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = own.agg(F.sum(text_bytes())).first()[0]
    order = F.col("doc_id").asc_nulls_first()
    dealt = own.repartitionByRange(tasks(docs.sparkSession, parts(size, TASK_BYTES)), order, F.substring("text", 1, KEY_CHARS)).sortWithinPartitions(order, "text")
    return stored(dealt.mapInArrow(run, "uri string, first_doc long, last_doc long, docs long, ids long, part int, number int"), "shard-list")


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start: ids of all documents before it, ids: array of int) of every document of the listed shards."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(r["uri"])
                ids = shard.all_ids().view(np.int32)
                bounds, step = np.append(shard.before, shard.total), 4096
                for k in range(0, shard.docs, step):
                    b = bounds[k : k + step + 1]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[k : k + step], pa.int64()), pa.array(r["before"] + b[:-1]), pa.ListArray.from_arrays(pa.array((b - b[0]).astype(np.int32)), pa.array(ids[b[0] : b[-1]]))], ["doc_id", "start", "ids"])

    return _with_starts(shards).mapInArrow(run, "doc_id long, start long, ids array<int>")


def _with_starts(shards: DataFrame) -> DataFrame:
    """(uri, before: ids of all shards before it), dealt to tasks.  Only the list of writing tasks is ordered as a whole."""
    earlier = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = shards.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", earlier(Window.orderBy("part")).alias("base"))
    placed = shards.join(tasks, "part").select("uri", (F.col("base") + earlier(Window.partitionBy("part").orderBy("number"))).alias("before"))
    size = shards.agg(F.sum("ids").alias("ids"), F.count("*").alias("n")).first()
    n = min(size["n"], max(4 * shards.sparkSession.sparkContext.defaultParallelism, parts(size["ids"], READ_IDS)))
    return placed.repartition(max(1, n), F.xxhash64("uri"))


def shard_digests(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files read back."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(r["uri"])
                ids = memoryview(shard.all_ids().astype("<u4").tobytes())
                bounds = np.append(shard.before, shard.total)
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(r["before"] + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
            release()

    return _with_starts(shards).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, added_tokens: bool = True) -> DataFrame:
    return shard_digests(write_shards(docs, fresh_path(docs.sparkSession, "ids"), added_tokens=added_tokens))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), added_tokens=True)
