"""Whole Arrow text columns as byte arrays: slices, words, hashes.

Everything here works on one Arrow batch inside a task. A slice holds whole
texts and about a megabyte (or one longer text), so the arrays derived from it
stay small. Nulls are empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# The white space that separates words.
SEPARATORS = b" \t\n\x0b\x0c\r"

IS_WORD = np.ones(256, bool)
IS_WORD[np.frombuffer(SEPARATORS, np.uint8)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: bytes that begin a code point
IS_CHAR = (np.arange(256) & 0xC0) != 0x80

_RADIX = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RADIX, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20250101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED_VALUES = _BYTE_VALUES[LOWER]


def give_back() -> None:
    """Return freed memory to the system, as far as its library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(function: Callable) -> Callable:
    """A function over Arrow batches that gives memory back when its task ends.

    Spark keeps Python workers for later tasks; what one operator has needed
    would stay beside the memory of the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def byte_class(characters: bytes) -> np.ndarray:
    """A lookup table that is true for these bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)``; offsets count from the slice's first byte."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        first, end = offsets[low], offsets[high]
        yield low, high, data[first:end], offsets[low : high + 1] - first
        low = high


def counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    so_far = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=so_far[1:])
    return so_far[offsets[1:]] - so_far[offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


# Powers of the hash's radix in two levels: a long text needs no table of its length.
_BLOCK = 1 << 16
_UP, _DOWN = _powers(_RADIX, _BLOCK), _powers(_INVERSE, _BLOCK)


def _of_blocks(base: int, blocks: int) -> np.ndarray:
    return _powers(pow(base, _BLOCK, 1 << 64), max(blocks, 1))


class RangeHash:
    """64-bit hashes of any byte ranges of a slice, from one running sum."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        values = _FOLDED_VALUES if fold else _BYTE_VALUES
        blocks = len(data) // _BLOCK + 1
        up = _of_blocks(_RADIX, blocks)
        self.down = _of_blocks(_INVERSE, blocks)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for i, low in enumerate(range(0, len(data), _BLOCK)):
            part = values[data[low : low + _BLOCK]]
            part *= _UP[: len(part)]
            np.cumsum(part, out=part)
            part *= up[i]
            part += self.sums[low]
            self.sums[low + 1 : low + 1 + len(part)] = part

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.sums[end] - self.sums[begin]
        out *= _DOWN[begin & (_BLOCK - 1)]
        out *= self.down[begin >> 16]
        return mix(out)


@dataclass
class Words:
    """Words of a slice: byte ranges, and the number of words before each text."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text(self) -> np.ndarray:
        """The text (row of the slice) of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(begin, end, np.searchsorted(begin, offsets))


def windows(hashes: np.ndarray, found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words, and where its first word stands among the words."""
    count = np.diff(found.first)
    left = np.repeat(found.first[1:], count) - np.arange(len(hashes))
    start = np.flatnonzero(left >= size)
    total = np.zeros(len(start), np.uint64)
    for k in range(size):
        total = total * np.uint64(_RADIX) + hashes[start + k]
    return mix(total), start
