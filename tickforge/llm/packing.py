"""Sorted integers packed into small binary messages between tasks."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned 32-bit integers as byte planes of their differences, compressed."""
    gaps = np.diff(values.astype(np.uint32), prepend=np.uint32(0))
    return zstandard.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as byte planes, compressed; for values of which most are small."""
    return zstandard.compress(np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unplanes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def squeeze(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def unsqueeze(packed: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), dtype)


def coded(keys: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | remainder of each 64-bit key, in the keys' own order: as many bits as buckets has, and 32 more."""
    bits = np.uint64(max(1, int(buckets).bit_length()))
    scaled = (keys >> bits) * np.uint64(buckets)
    return ((scaled >> (np.uint64(64) - bits)) << np.uint64(32)) | ((scaled << bits) >> np.uint64(32))


def by_bucket(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each bucket in sorted codes."""
    buckets = codes >> np.uint64(32)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(codes)]]) if len(codes) else np.zeros(1, int)
    return [(int(buckets[lo]), int(lo), int(hi)) for lo, hi in zip(cuts[:-1], cuts[1:])]
