"""Whole Arrow batches of text as byte arrays: word spans, 64-bit word hashes and rolling word n-grams, without a Python loop per word.

A null text counts as empty.  Texts are handled in slices of about ``SLICE`` bytes; a longer text is a slice of its own,
so nothing is ever cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
ROLL = np.uint64(0xD6E8FEB86659FD93)


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task, since a Python process goes on to serve other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it has its own way


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values of the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Digits, letters and every byte of a character beyond ASCII, once A-Z are lower case.
WORD_BYTES = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets) of consecutive rows."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(BASE), -1, 1 << 64)
    up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, np.uint64(inverse), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of set bytes that lies in one row, and the number of the first run of each row."""
    n = len(mask)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    edges = offsets[:-1]
    before[edges[edges < n]] = False
    after[edges[(edges > 0)] - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the number of the first word of each row (one more entry than rows)."""
    data = LOWER[data]
    starts, ends, first = spans(WORD_BYTES[data], offsets)
    return span_hashes(data, starts, ends), first


def text_hashes(words: list[str]) -> np.ndarray:
    """The same hashes for given words, one word per entry."""
    data, offsets = joined_bytes(words)
    return span_hashes(data, offsets[:-1], offsets[1:])


def joined_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [x.encode() for x in texts]
    offsets = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(x) for x in encoded], out=offsets[1:])
    return np.frombuffer(b"".join(encoded), np.uint8), offsets


def ngrams_of(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of k words in a row, none across rows, and the number of the first one of each row."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=out_first[1:])
    n = len(words) - (k - 1)
    if n <= 0:
        return np.zeros(0, np.uint64), out_first
    rolled = words[:n].copy()
    for j in range(1, k):
        rolled *= ROLL
        rolled += words[j : j + n]
    rolled = mixed(rolled + np.uint64(k))
    if k > 1:
        inside = np.zeros(n + 1, np.int8)
        begins, ends = first[:-1][counts > 0], first[:-1][counts > 0] + counts[counts > 0]
        np.add.at(inside, begins, 1)
        np.add.at(inside, ends, -1)
        rolled = rolled[np.cumsum(inside[:-1]) > 0]
    return rolled, out_first


def row_numbers(first: np.ndarray) -> np.ndarray:
    """For each entry, the number of the row that holds it."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the entries of each row, 0 for rows without entries, independent of the other rows of the batch."""
    shape = (len(first) - 1, *values.shape[1:])
    out = np.zeros(shape, values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return out


def distinct_shingles(words: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of one text and how often each stands; a text of 1 to k-1 words is one shingle."""
    if len(words) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(k, len(words))
    grams, _ = ngrams_of(words, np.array([0, len(words)]), size)
    return np.unique(grams, return_counts=True)


class Members:
    """A sorted set of 64-bit hashes with a fast first test by 20 bits, for a set that fits in a task."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(np.uint64))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def positions(self, values: np.ndarray) -> np.ndarray:
        """Positions in ``values`` that hold a member."""
        near = np.flatnonzero(self.bits[(values >> np.uint64(44)).astype(np.int64)])
        if len(near) == 0 or len(self.hashes) == 0:
            return near[:0]
        at = np.searchsorted(self.hashes, values[near])
        at[at == len(self.hashes)] = 0
        return near[self.hashes[at] == values[near]]
