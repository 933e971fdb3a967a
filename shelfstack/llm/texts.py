"""Whole texts as UTF-8 bytes in numpy: blocks of rows, words, hashes and word shingles.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A word's hash is a polynomial over its bytes
modulo 2**64, read off prefix sums, and mixed afterwards; everything is done for a block of rows at a
time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20  # rows are cut into blocks of about this much text; a longer text is a block by itself
SMALL_BLOCK_BYTES = 1 << 18  # for steps that hold some hundred bytes per byte of text
_POWER_STEP = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the word (a bijection)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = (n // _POWER_STEP + 1) * _POWER_STEP
        step = np.full(size, _BASE, U64)
        step[0] = 1
        back = np.full(size, pow(_BASE, -1, 1 << 64), U64)
        back[0] = 1
        _powers = (np.multiply.accumulate(step), np.multiply.accumulate(back))
    return _powers


class SpanHash:
    """64-bit hashes of any byte spans of one block, from prefix sums."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        forward, self.back = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((_LOWER if lower else _BYTE)[data] * forward[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(value + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the rows' offsets in them; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def hand_back() -> None:
    """Gives memory that is free inside this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def handing_back(run: Callable) -> Callable:
    """The same function of batches, after whose last one a worker that waits for its next task keeps no free memory."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        hand_back()

    return wrapped


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; no word crosses rows."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return start, end, row


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every lower-cased word of a text column."""
    data, offsets = utf8(column)
    start, end, row = words(data, offsets)
    return SpanHash(data, lower=True)(start, end), row


def shingles(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of every row as (row, hash), sorted by both.

    A row of fewer words is one shingle of its whole sequence; a row without words has none.
    """
    factors = mix(np.arange(1, n + 1, dtype=U64)) | U64(1)
    total = len(hashes)
    found_row, found = [], []
    if total >= n:
        whole = row[: total - n + 1] == row[n - 1 :]
        value = np.zeros(total - n + 1, U64)
        for j in range(n):
            value += hashes[j : total - n + 1 + j] * factors[j]
        found_row.append(row[: total - n + 1][whole])
        found.append(mix(value[whole]))
    if total:
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        count = np.diff(np.r_[first, total])
        for c in range(1, n):
            at = first[count == c]
            if len(at):
                value = np.full(len(at), c, U64)
                for j in range(c):
                    value += hashes[at + j] * factors[j]
                found_row.append(row[at])
                found.append(mix(value))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    r, h = np.concatenate(found_row), np.concatenate(found)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])] if len(r) else np.zeros(0, bool)
    return r[new], h[new]
