"""Counts of 64-bit keys within a task: added up in numpy, sent packed by range of keys, merged by range."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wavesym.llm.text import U64, mix

HELD = 1 << 20  # keys that a task holds before it sends them on
PACKED = "range long, n long, packed binary"


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and the sums of the rows of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first, axis=0)


def _planes(values: np.ndarray) -> bytes:
    """The bytes of one place side by side."""
    if not values.size:
        return b""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Ascending keys as gaps, then `values`: a row of equal width for each key."""
    gaps = np.diff(keys, prepend=U64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(_planes(gaps) + _planes(np.ascontiguousarray(values)))


def unpack(raw: bytes, n: int, kind: np.dtype, width: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    keys = np.cumsum(np.ascontiguousarray(data[: 8 * n].reshape(8, n).T).view("<u8").reshape(-1), dtype=np.uint64)
    return keys, np.ascontiguousarray(data[8 * n :].reshape(-1, n).T).view(kind).reshape(n, width)


class Counter:
    """Adds up rows of `width` counts by key and gives packed rows, one per range, whenever it is full."""

    def __init__(self, ranges: int, width: int, shift: int = 0, held: int = HELD):
        self.ranges, self.width, self.shift, self.held = ranges, width, U64(shift), held
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts.reshape(len(keys), self.width)))
        self.size += len(keys)
        if self.size > self.held:
            self._merge()
            if self.size > self.held // 2:
                yield from self.flush()

    def _merge(self) -> None:
        keys, counts = add_up(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.size = [(keys, counts)], len(keys)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        self._merge()
        (keys, counts), self.parts, self.size = self.parts[0], [], 0
        of = range_of(keys, self.ranges, self.shift)
        order = np.argsort(of.astype(np.min_scalar_type(self.ranges)), kind="stable")  # few bits sort fast
        cuts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=self.ranges))])
        some = np.flatnonzero(np.diff(cuts)).tolist()
        for low in range(0, len(some), 64):
            rows = [(k, order[cuts[k] : cuts[k + 1]]) for k in some[low : low + 64]]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": [k for k, _ in rows],
                    "n": [len(own) for _, own in rows],
                    "packed": [pack(keys[own], counts[own].astype("<u4")) for _, own in rows],
                }
            )


def range_of(keys: np.ndarray, ranges: int, shift) -> np.ndarray:
    """Keys that agree but for the last `shift` bits are in one range."""
    return (mix(keys >> U64(shift)) % U64(ranges)).astype(np.int64)


def merged(packed: DataFrame, names: list[str], least: int = 0) -> DataFrame:
    """key and the sums of its counts (`names`), of keys whose first count reaches `least`; packed rows of a range
    are added up one after the other."""

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = np.zeros(0, np.uint64), np.zeros((0, len(names)), np.int64)
        parts, held = [], 0
        for n, raw in zip(table.column("n").to_pylist(), table.column("packed")):
            more, own = unpack(raw.as_py(), n, "<u4", len(names))
            parts.append((more, own.astype(np.int64)))
            held += n
            if held > len(keys) + HELD // 4:
                keys, counts = add_up(*(np.concatenate(x) for x in zip((keys, counts), *parts)))
                parts, held = [], 0
        keys, counts = add_up(*(np.concatenate(x) for x in zip((keys, counts), *parts)))
        some = counts[:, 0] >= least
        columns = [pa.array(keys[some].view(np.int64)), *(pa.array(counts[some, k]) for k in range(len(names)))]
        return pa.table(columns, ["key", *names])

    return packed.groupBy("range").applyInArrow(merge, "key long, " + ", ".join(f"{c} long" for c in names))
