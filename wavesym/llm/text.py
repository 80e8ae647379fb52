"""Words and shingles of UTF-8 texts, computed for a slice of an Arrow column at a time.

A word hash is a polynomial over random byte values modulo 2**64, mixed at the end; it depends on the
bytes of the word alone, so every task and every run gives the same value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 3 << 20
WINDOW = 1 << 18

_random = np.random.default_rng(7919)
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_MASK = 2**64 - 1
SHINGLE = 5
_PLACE = _random.integers(1, 2**64, SHINGLE, dtype=np.uint64) | U64(1)
_SHORT = _random.integers(1, 2**64, SHINGLE, dtype=np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
BLANK = np.zeros(256, bool)
BLANK[32] = True


def _powers(base: int) -> np.ndarray:
    out = np.full(WINDOW, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _UNPOWER = _powers(_BASE), _powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of some `most` bytes, one row at least."""
    data, offsets = utf8(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = WHITE):
    """Starts, ends (byte positions) and rows of the maximal runs without a byte of `gaps`."""
    inside = ~gaps[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = before[1:]  # False where the next byte starts a row or is after a gap
    after[:-1] &= inside[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; `fold` makes A-Z and a-z equal."""
    table = _FOLDED if fold else _BYTE
    sums = np.zeros(len(starts), np.uint64)
    for low in range(0, len(data), WINDOW):
        high = min(low + WINDOW, len(data))
        first = int(np.searchsorted(ends, low, "right"))  # words with bytes in the window
        last = int(np.searchsorted(starts, high))
        if first == last:
            continue
        begin = np.maximum(starts[first:last], low) - low
        stop = np.minimum(ends[first:last], high) - low
        values = table[data[low:high]] * _POWER[: high - low]
        cuts = np.empty(2 * len(begin), np.int64)
        cuts[::2], cuts[1::2] = begin, stop
        if cuts[-1] == high - low:
            cuts = cuts[:-1]
        part = np.add.reduceat(values, cuts)[::2] * _UNPOWER[begin]
        if starts[first] < low:  # goes on from the window before
            part[0] = U64(int(part[0]) * pow(_BASE, int(low - starts[first]), 2**64) & _MASK)
        sums[first:last] += part
    return mix(sums + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int = SHINGLE):
    """Hashes of the runs of `size` words and the bounds of each row's runs.

    A row of fewer words has its whole sequence as its only run; one without words has none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(out_first[-1], np.uint64)
    if len(words) >= size:
        sums = words[: len(words) - size + 1] * _PLACE[0]
        for k in range(1, size):
            sums = sums + np.roll(words, -k)[: len(sums)] * _PLACE[k]
        keep = rows[: len(sums)] == rows[size - 1 :]
        long = np.repeat(counts >= size, runs)
        out[long] = mix(sums[keep])
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        few = words[first[row] : first[row + 1]]
        total = (few * _PLACE[: len(few)]).sum(dtype=np.uint64) 
        out[out_first[row]] = mix(np.array([total]) + _SHORT[len(few) : len(few) + 1])[0]
    return out, out_first
