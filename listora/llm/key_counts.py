"""Sorted 64-bit keys with counts, as compressed binary columns: what batches of documents send to buckets of keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, count: int, kind: type) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), dtype=kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpack(data, count, np.uint64), dtype=np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of counts of each."""
    if not len(keys):
        return keys.astype(np.uint64), counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts.astype(np.int64), first)
