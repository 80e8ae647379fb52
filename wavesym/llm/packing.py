"""Packing of token pieces by a configuration linear program over their length histogram.

A configuration says how many pieces of each length share a sequence. The covering program asks for the fewest
sequences whose configurations hold every piece. Multiplicative weights solve it: lengths that are covered so
far lose weight, a knapsack dynamic program finds the configuration worth most under the weights, and it gets
its share. Whole multiples of the shares are taken, what is left goes best fit, longest first, by counts. All
of this sees only the histogram, at most as many numbers as a sequence has tokens. The pieces take their places
by rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavesym.llm.encode import encoder
from wavesym.llm.store import Work
from wavesym.llm.text import slices

ROUNDS = 300
ETA = 0.35


def best_configuration(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> dict[int, int]:
    """Index of length -> copies, the most worth that fits; unbounded knapsack."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(int(lengths[0]), capacity + 1):
        n = int(np.searchsorted(lengths, room, "right"))
        sums = value[room - lengths[:n]] + worth[:n]
        k = int(sums.argmax())
        if sums[k] > value[room - 1]:
            value[room], choice[room] = sums[k], k
        else:
            value[room] = value[room - 1]
    out: dict[int, int] = {}
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        k = int(choice[room])
        out[k] = out.get(k, 0) + 1
        room -= int(lengths[k])
    return out


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> list[tuple[dict[int, int], float]]:
    """Shares of configurations that cover the counts, about as few as can be."""
    if not len(lengths):
        return []
    covered = np.zeros(len(lengths))
    found: dict[tuple, float] = {}
    for _ in range(rounds):
        weight = np.exp(-ETA * (covered - covered.min()))
        config = best_configuration(lengths, weight / counts, capacity)
        at = np.fromiter(config, np.int64)
        copies = np.fromiter(config.values(), np.int64)
        share = float((counts[at] / copies).min())
        covered[at] += share * copies / counts[at]
        key = tuple(sorted(config.items()))
        found[key] = found.get(key, 0.0) + share
    area = sum(share * sum(int(lengths[k]) * n for k, n in key) for key, share in found.items())
    scale = float((lengths * counts).sum()) / area
    return [(dict(key), share * scale) for key, share in found.items()]


@dataclass(frozen=True)
class Run:
    """`times` sequences from number `first` on, each with these (length, copies)."""

    first: int
    times: int
    content: tuple[tuple[int, int], ...]


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[Run]:
    """Sequences for `histogram` (length -> pieces); every piece has exactly one place."""
    left = {k: n for k, n in histogram.items() if n}
    content: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    if left.get(capacity):
        content.append((left.pop(capacity), ((capacity, 1),)))
    lengths = np.array(sorted(left), np.int64)
    counts = np.array([left[int(k)] for k in lengths], np.float64)
    for config, share in sorted(fractional(lengths, counts, capacity, rounds), key=lambda x: -x[1]):
        own = {int(lengths[k]): n for k, n in config.items()}
        times = min([int(share), *(left[k] // n for k, n in own.items())])
        if times:
            content.append((times, tuple(sorted(own.items(), reverse=True))))
            for k, n in own.items():
                left[k] -= n * times
    content += _best_fit(left, capacity)
    out, first = [], 0
    for times, own in content:
        out.append(Run(first, times, own))
        first += times
    return out


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit, longest first, for counts: equal sequences are kept as one group."""
    open_by_room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            fits = np.flatnonzero(rooms[length:])
            if not len(fits):
                per = capacity // length
                full, rest = divmod(need, per)
                for times, copies in ((full, per), (1 if rest else 0, rest)):
                    if times:
                        room = capacity - copies * length
                        open_by_room.setdefault(room, []).append((times, {length: copies}))
                        rooms[room] = True
                break
            room = int(fits[0]) + length
            times, own = open_by_room[room].pop()
            used = min(times, need)
            if used < times:
                open_by_room[room].append((times - used, own))
            rooms[room] = bool(open_by_room[room])
            open_by_room.setdefault(room - length, []).append((used, own | {length: own.get(length, 0) + 1}))
            rooms[room - length] = True
            need -= used
    return [(t, tuple(sorted(own.items(), reverse=True))) for groups in open_by_room.values() for t, own in groups]


PIECES = "doc_id long, piece int, start long, length long, ids binary, part long, rank long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most `capacity` ids; of a longer document only the first piece may be shorter.

    `part` and `rank` number the pieces of a length within the task that made them.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        part, tail = TaskContext.get().partitionId(), np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, last, data, bounds in slices(batch.column("text")):
                rows = []
                for name, ids in zip(names[first:last], coder.encode(data, bounds)):
                    ids = np.append(ids, tail).astype("<u4")
                    start, stop = 0, len(ids) % capacity or min(capacity, len(ids))
                    piece = 0
                    while start < len(ids):
                        size = stop - start
                        rows.append((name, piece, start, size, ids[start:stop].tobytes(), part, int(seen[size])))
                        seen[size] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "piece", "start", "length", "ids", "part", "rank"],
                )

    return texts.mapInArrow(cut, PIECES)


def place(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """Adds sequence_id and offset to rows with `length` and `place`, the rank among the pieces of the length.

    The table of runs is bounded by the capacity, not by the pieces.
    """
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    for run in runs:
        offset = 0
        for length, copies in run.content:
            at = taken.get(length, 0)
            slots.setdefault(length, []).append((at, run.first, copies, offset))
            taken[length] = at + copies * run.times
            offset += length * copies
    rows = [(length << 44 | at, first, copies, offset) for length in sorted(slots) for at, first, copies, offset in slots[length]]
    keys, firsts, copies, offsets = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 4
    names = [c for c in pieces.columns if c != "place"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("place").to_numpy(zero_copy_only=False)
            run = np.searchsorted(keys, length << 44 | rank, "right") - 1
            nth = rank - (keys[run] & (2**44 - 1))
            sequence = firsts[run] + nth // copies[run]
            offset = offsets[run] + nth % copies[run] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    kinds = ", ".join(f"{c} {t}" for c, t in pieces.select(names).dtypes)
    return pieces.mapInArrow(put, f"{kinds}, sequence_id long, offset long")


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, work: Work | None = None, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Null texts are empty, so a document always has its end id. Null and repeated ids are packed like others.
    An empty table gives no rows. Other columns of `docs` are not read. `with_ids` adds the ids themselves
    (binary, little-endian u32).
    """
    work = work or Work(docs.sparkSession)
    pieces = work.table(cut_pieces(docs, tokenizer, end_id, capacity), "pieces", "zstd")
    sizes = work.table(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-sizes")
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *(["ids"] if with_ids else []), "part", "rank"
    ).join(offsets, ["part", "length"])
    numbered = numbered.withColumn("place", F.col("rank") + F.col("before")).drop("part", "rank", "before")
    return place(numbered, plan(histogram, capacity))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed token sequences, from `pack(..., with_ids=True)`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence has at most `capacity` ids
    joined = F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
