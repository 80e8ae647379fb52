"""Token-ID files of patched frame-of-reference blocks.

A shard holds the ids of a range of documents as blocks of 1024. A block stores its minimum, the differences
to it packed at a width that a percentile of their sizes gives, and the parts that stick out of that width in
an exception list. After the blocks come the index of block starts and the index of documents.

    shard    = magic, blocks, block starts (u64 each), documents (i64 id, u8 present, u64 count each), trailer
    trailer  = u64 blocks, u64 documents, u64 ids, magic
    block    = u32 minimum, u16 ids, u16 exceptions, u8 width, 7 bytes 0, 16 lanes of `width` u64,
               u16 position per exception (padded to 8), u32 high part per exception (padded to 8)

Value k of a block lies in lane k mod 16, there in row k div 16, rows packed from the lowest bit up.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavesym.llm.encode import encoder
from wavesym.llm.store import Work, make_folder, new_file, open_read, open_write
from wavesym.llm.text import slices

MAGIC = b"PFORIDS1"
BLOCK, LANES, ROWS = 1024, 16, 64
PERCENTILES = (50, 75, 90, 95, 98, 99, 100)
_U64 = np.uint64
_HEAD = struct.Struct("<IHHB7x")
_TRAILER = struct.Struct("<QQQ8s")


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _widths(bits: np.ndarray) -> np.ndarray:
    """Per block the percentile width with the fewest bytes."""
    ordered = np.sort(bits, axis=1)
    best = np.full(len(bits), 2**31)
    width = np.zeros(len(bits), np.uint8)
    for percentile in PERCENTILES:
        w = ordered[:, max(0, -(-BLOCK * percentile // 100) - 1)]
        out = (ordered > w[:, None]).sum(axis=1)
        cost = 128 * w.astype(np.int64) + 6 * out
        better = cost < best
        best, width = np.where(better, cost, best), np.where(better, w, width)
    return width


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """[n, 1024] values below 2**width as [n, width, 16] words."""
    v = values.reshape(len(values), ROWS, LANES).astype(_U64)
    out = np.zeros((len(values), width, LANES), _U64)
    for k in range(ROWS):
        word, shift = divmod(k * width, 64)
        if word < width:
            out[:, word] |= v[:, k] << _U64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, k] >> _U64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), ROWS, LANES), _U64)
    mask = _U64(2**width - 1)
    for k in range(ROWS):
        word, shift = divmod(k * width, 64)
        if width:
            v = words[:, word] >> _U64(shift)
            if shift + width > 64:
                v = v | (words[:, word + 1] << _U64(64 - shift))
            out[:, k] = v & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of 1024 ids, the last one of what is left."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    full = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], np.uint32)]).reshape(n, BLOCK)
    low = full.min(axis=1)
    delta = full - low[:, None]
    widths = _widths(_bit_lengths(delta))
    out: list[bytes] = [b""] * n
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        part = delta[at]
        packed = _pack(part & np.uint32(2 ** int(width) - 1), int(width))
        high = (part.astype(_U64) >> _U64(width)).astype(np.uint32)
        rows, places = np.nonzero(high)
        cuts = np.searchsorted(rows, np.arange(len(at) + 1))
        for k, block in enumerate(at.tolist()):
            own = slice(cuts[k], cuts[k + 1])
            positions = places[own].astype("<u2").tobytes()
            parts = high[k, places[own]]
            size = min(BLOCK, len(ids) - block * BLOCK)
            head = _HEAD.pack(int(low[block]), size, len(parts), int(width))
            out[block] = head + packed[k].astype("<u8").tobytes() + _even(positions) + _even(parts.astype("<u4").tobytes())
    return out


def _even(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at these places of `raw`."""
    heads = [_HEAD.unpack_from(raw, s) for s in starts.tolist()]
    full = np.empty((len(heads), BLOCK), np.uint32)
    widths = np.array([h[3] for h in heads], np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        words = np.stack([np.frombuffer(raw, "<u8", width * LANES, starts[b] + _HEAD.size) for b in at])
        values = _unpack(words.reshape(len(at), width, LANES), int(width))
        for k, block in enumerate(at.tolist()):
            low, _, n, _ = heads[block]
            place = int(starts[block]) + _HEAD.size + 128 * int(width)
            if n:
                positions = np.frombuffer(raw, "<u2", n, place)
                high = np.frombuffer(raw, "<u4", n, place + 2 * n + (-2 * n) % 8)
                values[k, positions] |= high.astype(_U64) << _U64(width)
            full[block] = (values[k] + _U64(low)).astype(np.uint32)
    sizes = np.array([h[1] for h in heads])
    if (sizes == BLOCK).all():
        return full.reshape(-1)
    return np.concatenate([full[k, :s] for k, s in enumerate(sizes.tolist())])


class ShardWriter:
    """Writes blocks as ids arrive; keeps only the indexes in memory."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        self.starts: list[int] = []
        self.docs: list[tuple[int, int, int]] = []
        self.rest = np.zeros(0, np.uint32)
        self.ids = 0
        stream.write(MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        for block in encode_blocks(ids):
            self.starts.append(self.at)
            self.stream.write(block)
            self.at += len(block)

    def add(self, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
        self.docs += [(d or 0, d is not None, len(i)) for d, i in zip(doc_ids, ids)]
        self.ids += sum(map(len, ids))
        joined = np.concatenate([self.rest, *ids])
        whole = len(joined) // BLOCK * BLOCK
        self._blocks(joined[:whole])
        self.rest = joined[whole:].copy()

    def close(self) -> None:
        self._blocks(self.rest)
        self.stream.write(np.array(self.starts, "<u8").tobytes())
        for column, kind in zip(zip(*self.docs), ("<i8", "u1", "<u8")):
            self.stream.write(np.array(column, kind).tobytes())
        self.stream.write(_TRAILER.pack(len(self.starts), len(self.docs), self.ids, MAGIC))
        self.stream.close()


class ShardReader:
    def __init__(self, file):
        self.file = file
        size = file.size()
        self.blocks, n_docs, self.ids, magic = _TRAILER.unpack(file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.end = size - _TRAILER.size - 17 * n_docs - 8 * self.blocks
        index = file.read_at(8 * self.blocks + 17 * n_docs, self.end)
        self.starts = np.frombuffer(index, "<u8", self.blocks).astype(np.int64)
        at = 8 * self.blocks
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, at)
        self.present = np.frombuffer(index, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(index, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)

    def read_blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of some blocks, found by the index."""
        low = self.starts[first]
        high = self.starts[last] if last < self.blocks else self.end
        return decode_blocks(self.file.read_at(int(high - low), int(low)), self.starts[first:last] - low)

    def documents(self, blocks: int = 2048) -> Iterator[tuple[list[int | None], np.ndarray, list[np.ndarray]]]:
        """(doc ids, starts within the shard, ids) of runs of documents."""
        ends = np.cumsum(self.counts)
        row, rest, at = 0, np.zeros(0, np.uint32), 0  # `rest` begins at id `at`
        for first in range(0, self.blocks, blocks):
            rest = np.concatenate([rest, self.read_blocks(first, min(first + blocks, self.blocks))])
            last = int(np.searchsorted(ends, at + len(rest), "right"))
            if last > row:
                starts = ends[row:last] - self.counts[row:last]
                names = [int(d) if p else None for d, p in zip(self.doc_ids[row:last], self.present[row:last])]
                yield names, starts, [rest[s - at : e - at] for s, e in zip(starts.tolist(), ends[row:last].tolist())]
                rest, at, row = rest[int(ends[last - 1]) - at :].copy(), int(ends[last - 1]), last


MANIFEST = "shard long, path string, n_docs long, n_ids long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """One shard per range of doc_id; returns the manifest, a row per shard in ascending order of documents.

    Null texts are empty; each document ends with `end_id`. Documents without an id come first. Rows that
    repeat an id follow one another by a hash of the text. Other columns of `docs` are not read.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        tail = np.array([end_id], np.uint32)
        coder, writer, path = encoder(tokenizer), None, None
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, last, data, bounds in slices(batch.column("text")):
                if writer is None:
                    path = new_file(folder, f"ids-{shard:08d}", ".pfor")
                    writer = ShardWriter(open_write(path))
                writer.add(names[first:last], [np.append(i, tail) for i in coder.encode(data, bounds)])
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]}
            )

    return ordered.mapInArrow(write, MANIFEST)


def read_tokens(manifest: DataFrame, shards: int) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (binary, little-endian u32) of every document."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).select("path", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with open_read(path) as file:
                    for names, starts, ids in ShardReader(file).documents():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(names, pa.int64()),
                                pa.array(starts + before, pa.int64()),
                                pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                            ],
                            ["doc_id", "start", "ids"],
                        )

    return placed.repartition(max(1, shards)).mapInArrow(read, "doc_id long, start long, ids binary")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, work: Work | None = None) -> DataFrame:
    """Writes the shards to the shared folder and reads them back; empty input gives no rows."""
    work = work or Work(docs.sparkSession)
    folder = work.folder("token-ids")
    make_folder(folder)
    manifest = work.table(write_tokens(docs, folder, tokenizer, end_id), "token-manifest")
    return read_tokens(manifest, manifest.count())
