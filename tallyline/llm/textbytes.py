"""Texts of an Arrow column as UTF-8 bytes in numpy, a bounded block at a time.

A null text counts as an empty one. All functions are pure and hold a block's arrays only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1_000_000

ROOT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def release_memory() -> None:
    """Give back what Arrow and the allocator keep of freed memory; a worker serves many tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The step over batches, which gives memory back when it has ended."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return tidied


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the len + 1 places where texts begin."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most limit bytes, or of a single longer text."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ROOT ** i and its inverse modulo 2**64 for i up to n."""
    inverse = pow(ROOT, -1, 1 << 64)
    up = np.full(n + 1, ROOT, np.uint64)
    down = np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    data = np.ascontiguousarray(data)
    return np.ndarray((max(0, len(data) - 7),), "<u8", buffer=data, strides=(1,)).copy() if len(data) > 7 else np.zeros(0, np.uint64)


def string_hashes(words: np.ndarray, size: int, place: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the strings of so many (at least eight) bytes from each place, or from some, on."""
    steps = [*range(0, size - 8, 8), size - 8]
    count = max(0, len(words) - steps[-1])
    out = np.full(count if place is None else len(place), size, np.uint64)
    for step in steps:
        out ^= words[step : step + count] if place is None else words[place + step]
        out *= np.uint64(ROOT)
        out ^= out >> np.uint64(32)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(29)
    return out


class Spans:
    """Hashes of any byte ranges of one block, from prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def table(spans: list[tuple[int, int]]) -> np.ndarray:
    """A lookup table of bytes: true within the inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in spans:
        out[low : high + 1] = True
    return out


SPACES = table([(0x20, 0x20), (0x09, 0x0D)])


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of true; runs end where a text ends."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    begins, ends = inside.copy(), inside.copy()
    cut = np.zeros(len(inside) + 1, bool)
    cut[at] = True
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def windows(word_hash: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of so many words within one text, and the place of their first word."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.flatnonzero(doc[:n] == doc[size - 1 :])
    out = np.zeros(len(place), np.uint64)
    for k in range(size):
        out = out * np.uint64(ROOT) + word_hash[place + k]
    return mix(out), place


def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the flags of each text are true."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]
