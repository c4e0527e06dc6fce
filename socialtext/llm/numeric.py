"""Numpy on the bytes of an Arrow batch: pieces of bounded size, words, rolling hashes of any span in constant time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once in a Python worker (a longer single text is handled alone).
PIECE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64)  # a copy
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Spans:
    """Hash of any span of ``data`` (bytes, or 64-bit numbers): a polynomial over 64-bit numbers, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _powers(max(1 << (len(data) + 1).bit_length(), 2 * PIECE_BYTES))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_VALUE[data] if data.dtype == np.uint8 else mix(data)) * self.up[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, last row + 1, bytes, offsets`` of whole texts, about ``limit`` bytes at a time. Null is empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, text number`` of every word ``[^\\x20\\x09-\\x0D]+``; words never cross texts."""
    solid = ~_SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    if len(data):
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[filled] = solid[filled]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[last] = solid[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1
