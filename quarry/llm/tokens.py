"""Whitespace words of UTF-8 columns as numpy arrays, a few megabytes at a time.

A word is a maximal run of bytes other than ``20`` and ``09``-``0D`` (every
operator here uses that rule). All separators are ASCII, so the work is done on
the Arrow buffer's bytes and no text is decoded. ``A``-``Z`` are lower-cased for
the hashes; other letters are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
HASH_BYTES = 1 << 18  # hashed at a time: each byte takes 40 bytes of powers and sums

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, HASH_BYTES)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes and per-text offsets."""

    first: int            # index of the first text in the batch
    count: int            # number of texts
    data: np.ndarray      # uint8, the texts' bytes end to end
    begin: np.ndarray     # int64, byte start of each word in data
    end: np.ndarray       # int64, byte end (exclusive)
    ptr: np.ndarray       # int64, words of text i are ptr[i]:ptr[i + 1]
    text_ptr: np.ndarray  # int64, bytes of text i are text_ptr[i]:text_ptr[i + 1]

    def hashes(self) -> np.ndarray:
        """64-bit hash of every lower-cased word (polynomial, then mixed with the length)."""
        out = np.empty(len(self.begin), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.begin[i] + HASH_BYTES)))
            lo, hi = int(self.begin[i]), int(self.end[j - 1])
            power, inverse = _power_tables(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_LOWER[self.data[lo:hi]] * power, out=total[1:])
            b, e = self.begin[i:j] - lo, self.end[i:j] - lo
            out[i:j] = mix((total[e] - total[b]) * inverse[b] + (e - b).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            i = j
        return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data, offsets


def runs(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, count, bytes, offsets)`` for runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j - i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    for run in runs(column, limit):
        yield _words(*run)


def _words(first: int, count: int, data: np.ndarray, text_ptr: np.ndarray) -> Words:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[text_ptr] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(first, count, data, begin, end, np.searchsorted(begin, text_ptr), text_ptr)


def shingles(hashes: np.ndarray, ptr: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their offsets.

    A text of fewer than ``width`` words (but at least one) has its whole word
    sequence as its only shingle; a text without words has none.
    """
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    n = max(0, len(hashes) - width + 1)
    joined = hashes[:n].copy()
    for k in range(1, width):
        joined = joined * step + hashes[k:n + k]
    joined = mix(joined + np.uint64(width))
    parts, sizes = [], np.zeros(len(ptr), np.int64)
    for i in range(len(ptr) - 1):
        a, b = int(ptr[i]), int(ptr[i + 1])
        if b - a >= width:
            own = np.unique(joined[a:b - width + 1])
        elif b > a:
            x = hashes[a:a + 1]
            for k in range(a + 1, b):
                x = x * step + hashes[k:k + 1]
            own = mix(x + np.uint64(b - a))
        else:
            continue
        parts.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.cumsum(sizes)


def list_array(flat: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(flat))
