"""Vectorised text kernels that tasks run on Arrow batches.

Texts are looked at as one run of UTF-8 bytes with document offsets; words, their hashes
and their shingles are found for all documents of a slice at once with numpy.
Nulls count as empty texts.  Memory follows the slice, not the batch or the partition.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 20


def _spread(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every input bit reaches every output bit (in a new array)."""
    x = x ^ (x >> U64(31))
    x *= U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


_BYTE_CODE = _spread(np.arange(1, 257, dtype=U64) * U64(0x9E6C63D0876A9A47))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Codes of bytes after A-Z became a-z.
_LOWER_CODE = _BYTE_CODE[_LOWER]
#: Bytes between words: space, and 09 to 0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BASE = U64(0xD6E8FEB86659FD93)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}
_PRIME = U64((1 << 31) - 1)
_PRIME_BASES = tuple(pow(7, k, int(_PRIME)) for k in (1_234_567_891, 1_700_000_009))  # primitive roots
_prime_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Codes of bytes below the prime, a row for each base; in LOWER_CODES A-Z are as a-z.
BYTE_CODES = _spread(np.arange(1, 513, dtype=U64) * U64(0xE7037ED1A0B428DB)).reshape(2, 256) % _PRIME
LOWER_CODES = BYTE_CODES[:, _LOWER]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) <= n:
        size = 1 << int(n + 1).bit_length()
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def _fold(x: np.ndarray) -> np.ndarray:
    """x, made below 2**32 in place; equal to what it was modulo the prime."""
    high = x >> U64(31)
    x &= _PRIME
    x += high
    return x


def _prime_powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of base k and of its inverse, modulo the prime."""
    held = _prime_tables.get(k)
    if held is None or len(held[0]) <= n:
        size, both = 1 << int(n + 1).bit_length(), []
        for base in (_PRIME_BASES[k], pow(_PRIME_BASES[k], -1, int(_PRIME))):
            table, done = np.ones(size, np.uint32), 1
            while done < size:
                table[done : 2 * done] = table[: min(done, size - done)].astype(U64) * U64(pow(base, done, int(_PRIME))) % _PRIME
                done *= 2
            both.append(table)
        held = _prime_tables[k] = tuple(both)
    return held


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of n+1 documents) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `most` bytes; a longer document is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document of each) of the words in data[offsets[0]:offsets[-1]]; `between` flags the bytes outside words.

    Starts and ends count from offsets[0].
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    gap = between[data[lo:hi]]
    edge = np.zeros(hi - lo + 1, dtype=bool)
    edge[offsets - lo] = True
    start, end = ~gap, ~gap
    start[1:] &= gap[:-1] | edge[1:-1]
    end[:-1] &= gap[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets[1:] - lo, starts, "right")


class Sums:
    """Polynomial sums over a run of bytes, modulo the prime 2**31 - 1, for two bases and codes that have nothing in common.

    The hash of any span of the run follows from them: 62 bits and the length.  Two spans of n bytes have the same one
    only where both polynomials of degree n vanish, so no pattern of bytes does that for every base, as patterns
    do modulo a power of two.  Where equal bytes must be sure, `distinct_spans` compares them.
    """

    def __init__(self, raw: np.ndarray, codes: np.ndarray):
        self.each = []
        for k in range(2):
            up, down = _prime_powers(k, len(raw))
            total = np.zeros(len(raw) + 1, dtype=U64)
            terms = codes[k][raw]
            terms *= up[: len(raw)]
            np.cumsum(_fold(terms), out=total[1:])
            self.each.append((total, down))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span of bytes."""
        a, b = (((total[ends] - total[starts]) % _PRIME * down[starts]) % _PRIME for total, down in self.each)
        return _spread(((a << U64(31)) | b) ^ _spread((ends - starts).astype(U64)))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = LOWER_CODES, block: int = SLICE_BYTES) -> np.ndarray:
    """A 64-bit hash of each span of bytes; the spans are in order and don't overlap."""
    out, i = np.empty(len(starts), dtype=U64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, "right")))
        lo = int(starts[i])
        out[i:j] = Sums(data[lo : int(ends[j - 1])], codes).spans(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out


def flat_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of spans, one span after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def unequal(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Which spans of data differ in any byte from their partners, spans of `other`."""
    wrong = sizes != other_sizes
    alike = np.flatnonzero(~wrong & (sizes > 0))
    n = sizes[alike]
    differ = data[flat_places(starts[alike], n)] != other[flat_places(other_starts[alike], n)]
    wrong[alike] = np.add.reduceat(differ, np.cumsum(n) - n) if len(alike) else False
    return wrong


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first, at): the different spans by key, where each is first met, and which of them each span is.

    Bytes are compared: of different spans with one hash, all but the first go on to other keys.
    """
    keys, sizes = span_hashes(data, starts, ends, BYTE_CODES if codes is None else codes), ends - starts
    while True:
        known, first, at = np.unique(keys, return_index=True, return_inverse=True)
        own = first[at]
        again = np.flatnonzero(own != np.arange(len(own)))
        wrong = again[unequal(data, starts[again], sizes[again], data, starts[own[again]], sizes[own[again]])]
        if not len(wrong):
            return known, first, at
        keys[wrong] = _spread(keys[wrong] + U64(1))


def release() -> None:
    """Give freed memory back to the system: a worker lives on from task to task, and what other stages freed in it would add to the next one's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class Grown:
    """An array that is appended to; `data` has room, `n` values are filled."""

    def __init__(self, dtype: type):
        self.data, self.n = np.zeros(1024, dtype), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(self.n // 4 + len(values), self.data.dtype)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class HeldSpans:
    """Spans of bytes, numbered as they come.  A span is found by its hash, and only if its bytes are the same."""

    def __init__(self, recent: int = 1 << 16):
        self.most_recent, self.keys = recent, [np.zeros(0, U64), np.zeros(0, U64)]  # a large sorted table, and a recent one that is merged into it now and then
        self.numbers = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.bytes, self.starts, self.sizes = Grown(np.uint8), Grown(np.int64), Grown(np.int32)

    def __len__(self) -> int:
        return self.sizes.n

    def find(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each span of raw; -1 where it isn't held, -2 where another one of its key is."""
        found = np.full(len(keys), -1)
        for held, numbers in zip(self.keys, self.numbers):
            place = np.searchsorted(held, keys)
            met = np.flatnonzero(place < len(held))
            met = met[held[place[met]] == keys[met]]
            found[met] = numbers[place[met]]
        met = np.flatnonzero(found >= 0)
        found[met[unequal(raw, starts[met], sizes[met], self.bytes.data, self.starts.data[found[met]], self.sizes.data[found[met]])]] = -2
        return found

    def add(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, findable: bool = True) -> np.ndarray:
        """The next numbers, for spans of keys that aren't held, in order of key; others are held too, but never found."""
        numbers = len(self) + np.arange(len(keys))
        self.starts.append(self.bytes.n + np.cumsum(sizes) - sizes)
        self.sizes.append(sizes)
        self.bytes.append(raw[flat_places(starts, sizes)])
        if not findable:
            return numbers
        into, new = 1, (keys, numbers.astype(np.int32))
        if len(self.keys[1]) + len(keys) > self.most_recent:
            order = np.argsort(both := np.concatenate([self.keys[1], keys]), kind="stable")
            into, new = 0, (both[order], np.concatenate([self.numbers[1], new[1]])[order])
            self.keys[1], self.numbers[1] = self.keys[1][:0], self.numbers[1][:0]
        at = np.searchsorted(self.keys[into], new[0])
        self.keys[into], self.numbers[into] = np.insert(self.keys[into], at, new[0]), np.insert(self.numbers[into], at, new[1])
        return numbers


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: tuple[int, ...], codes: np.ndarray = _LOWER_CODE, block: int = SLICE_BYTES) -> list[np.ndarray]:
    """Hashes of whole spans, then for each length those of the spans' first bytes (of the whole span where it is no longer)."""
    out = [np.empty(len(starts), dtype=U64) for _ in range(1 + len(lengths))]
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = powers(hi - lo)
        total = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum(codes[data[lo:hi]] * up[: hi - lo], out=total[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        before, shift = total[a], down[a]
        for k, size in enumerate((None, *lengths)):
            end = b if size is None else np.minimum(b, a + size)
            out[k][i:j] = ((total[end] - before) * shift) ^ (end - a).astype(U64)
        i = j
    return [_spread(x) for x in out]


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, its document) over data[offsets[0]:offsets[-1]]."""
    starts, ends, doc = word_spans(data, offsets)
    return span_hashes(data[int(offsets[0]) : int(offsets[-1])], starts, ends), doc


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct `size`-word shingles, by document and hash.

    A document of fewer words, but not none, has its whole sequence as its one shingle.
    """
    words, doc = hashed_words(data, offsets)
    n = len(offsets) - 1
    if not len(words):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    counts = np.bincount(doc, minlength=n)
    run = np.zeros(len(words), dtype=U64)
    for k in range(min(size, len(words))):
        run[: len(words) - k] = run[: len(words) - k] * U64(0xC2B2AE3D27D4EB4F) + words[k:]
    last = np.cumsum(counts)[doc]
    whole = np.arange(len(words)) + size <= last
    hashes, docs = _spread(run[whole]), doc[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        value = counts[short].astype(U64)
        for k in range(size - 1):
            has = counts[short] > k
            at = (last[np.searchsorted(doc, short)] - counts[short] + k)[has]
            value[has] = _spread(value[has] * U64(0xC2B2AE3D27D4EB4F) + words[at])
        hashes, docs = np.concatenate([hashes, _spread(value)]), np.concatenate([docs, short])
        order = np.argsort(docs, kind="stable")
        hashes, docs = hashes[order], docs[order]
    bounds = np.searchsorted(docs, np.arange(n + 1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashes[lo:hi].sort()
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    return hashes[first], docs[first]
