"""Numpy views of Arrow string columns: words, their hashes, and bounded slices of a batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The white space that separates words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Bytes with A to Z as a to z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

SLICE_BYTES = 1 << 21
# For work whose arrays take many times the bytes of a slice.
SMALL_SLICE_BYTES = 1 << 20

# Only the GNU C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_random = np.random.default_rng(20240611)
_BYTE = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row limits in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, limits, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    limits = np.frombuffer(limits, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[limits[0]:limits[-1]]
    return data, limits - limits[0]


def give_back() -> None:
    """Returns freed memory to the system: Arrow's pool and the C library keep it, the JVM needs it."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(limits: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text has a range of its own."""
    start, rows = 0, len(limits) - 1
    while start < rows:
        end = int(np.searchsorted(limits, limits[start] + size, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        give_back()
        start = end


def word_spans(data: np.ndarray, limits: np.ndarray, word: np.ndarray | None = None):
    """Start and end of every word, and the word index at which each row begins.

    ``word`` marks the bytes of words; by default those that are no white space.
    """
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(limits), np.int64)
    if word is None:
        word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[limits] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, limits)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hash of every word; by default with A to Z taken as a to z."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(byte[data] * power, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; the last ``size - 1`` places are not given."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = mix(total + words[k:k + n] + np.uint64(k + 1))
    return total
