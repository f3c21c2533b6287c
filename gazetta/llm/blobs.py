"""Arrays as compressed binary columns, questions of blocks to shards of a hash space, and memory given back."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

_ZIP = zstandard.ZstdCompressor(level=3)


def pack(x: np.ndarray) -> bytes:
    return _ZIP.compress(np.ascontiguousarray(x).tobytes())


def unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x, max_output_size=1 << 31), kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as differences, one plane of bytes after the other: the leading ones are mostly zero."""
    return pack(np.diff(keys, prepend=np.uint64(0)).view("u1").reshape(-1, 8).T)


def unpack_sorted(x: bytes) -> np.ndarray:
    planes = unpack(x, "u1").reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("u8").ravel(), dtype="u8")


def shares(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, start, end) of the shards that sorted keys fall into, by equal ranges of the hash space."""
    edges = np.array([(k << 64) // shards for k in range(1, shards)], "u8")
    ends = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(s, a, b) for s, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + length), one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.empty(0, "i8")
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one, free memory goes back to the system, as a worker waits for its next task."""
    yield from batches
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c"))
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
