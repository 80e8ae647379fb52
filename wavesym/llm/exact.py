"""Exact duplicates by counting quotient filters and a comparison of bytes.

Each task builds counting quotient filters of the 64-bit fingerprints it has read, one per segment of the
fingerprint space. A segment's filters merge without loss, as their remainders are sorted and their counters
add up. A fingerprint with a count above one sends its rows on: their bytes are compared with those of one row
of the group, so that no collision passes for a copy.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work

U64 = np.uint64
_HEAD = struct.Struct("<BBxxxxxxQQ")
SEGMENT_ROWS = 500_000


class CountingQuotientFilter:
    """Sorted fingerprints below a segment prefix: quotients as run lengths, remainders, counters.

    The low `quotient_bits + remainder_bits` bits of a fingerprint are stored, split in two: a run length
    for each quotient in use and the remainders of each run in ascending order. Counters of one are left out.
    """

    def __init__(self, prints: np.ndarray, counts: np.ndarray, remainder_bits: int):
        self.prints, self.counts, self.remainder_bits = prints, counts, remainder_bits

    @classmethod
    def build(cls, prints: np.ndarray, remainder_bits: int) -> CountingQuotientFilter:
        values, counts = np.unique(prints, return_counts=True)
        return cls(values, counts.astype(np.uint64), remainder_bits)

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        values, place = np.unique(np.concatenate([self.prints, other.prints]), return_inverse=True)
        counts = np.zeros(len(values), np.uint64)
        np.add.at(counts, place, np.concatenate([self.counts, other.counts]))
        return CountingQuotientFilter(values, counts, self.remainder_bits)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        many = self.counts > 1
        return self.prints[many], self.counts[many]

    def to_bytes(self) -> bytes:
        bits = U64(self.remainder_bits)
        quotients, runs = np.unique(self.prints >> bits, return_counts=True)
        gaps = np.diff(quotients, prepend=U64(0))
        remainders = self.prints & ((U64(1) << bits) - U64(1))
        width = -(-self.remainder_bits // 8)
        packed = remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        many = np.flatnonzero(self.counts > 1)
        return b"".join(
            [
                _HEAD.pack(self.remainder_bits, width, len(self.prints), len(quotients)),
                struct.pack("<Q", len(many)),
                gaps.astype("<u8").tobytes(),
                runs.astype("<u4").tobytes(),
                np.ascontiguousarray(packed).tobytes(),
                many.astype("<u4").tobytes(),
                self.counts[many].astype("<u8").tobytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        bits, width, n, n_quotients = _HEAD.unpack_from(raw)
        (n_many,) = struct.unpack_from("<Q", raw, _HEAD.size)
        at = _HEAD.size + 8
        quotients = np.cumsum(np.frombuffer(raw, "<u8", n_quotients, at), dtype=np.uint64)
        at += 8 * n_quotients
        runs = np.frombuffer(raw, "<u4", n_quotients, at)
        at += 4 * n_quotients
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        prints = (np.repeat(quotients, runs) << U64(bits)) | wide.view("<u8").reshape(-1)
        counts = np.ones(n, np.uint64)
        many = np.frombuffer(raw, "<u4", n_many, at)
        counts[many] = np.frombuffer(raw, "<u8", n_many, at + 4 * n_many)
        return cls(prints, counts, bits)


def normal_text(text: Column) -> Column:
    """White space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def build_filters(prints: DataFrame, segment_bits: int) -> DataFrame:
    """A filter per segment and task, of the column `fp`."""
    shift, remainder_bits = U64(64 - segment_bits), 40

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, CountingQuotientFilter] = {}
        for batch in batches:
            values = np.sort(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            segments = values >> shift if segment_bits else np.zeros(len(values), U64)
            names, first = np.unique(segments, return_index=True)
            for name, part in zip(names.tolist(), np.split(values, first[1:])):
                new = CountingQuotientFilter.build(part, remainder_bits)
                filters[name] = filters[name].merge(new) if name in filters else new
        for name in sorted(filters):
            yield pa.RecordBatch.from_pydict({"segment": [name], "filter": [filters[name].to_bytes()]})

    return prints.select("fp").mapInArrow(build, "segment long, filter binary")


def merge_filters(filters: DataFrame) -> DataFrame:
    """One filter per segment; a segment has a bounded number of fingerprints, copies are counters."""

    def merge(table: pa.Table) -> pa.Table:
        raw = table.column("filter").to_pylist()
        parts = [CountingQuotientFilter.from_bytes(x) for x in raw]
        while len(parts) > 1:
            parts = [parts[k].merge(parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return pa.table({"segment": table.column("segment")[:1], "filter": [parts[0].to_bytes()]})

    return filters.groupBy("segment").applyInArrow(merge, "segment long, filter binary")


def repeated_prints(filters: DataFrame) -> DataFrame:
    """fp, copies of the fingerprints with a count above one."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("filter").to_pylist():
                prints, counts = CountingQuotientFilter.from_bytes(raw).repeated()
                yield pa.RecordBatch.from_pydict(
                    {"fp": prints.view(np.int64), "copies": counts.astype(np.int64)}
                )

    return filters.mapInArrow(repeated, "fp long, copies long")


def exact_duplicates(docs: DataFrame, work: Work | None = None, fp_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal when identical after white space runs become one space; null counts as empty. The row
    with the smallest doc_id of a group is kept, null ids last. Of rows that repeat the kept id, or of a group
    without ids, exactly one is kept. Other columns of `docs` are not read; an empty table gives no rows.
    `fp_bits` below 64 makes fingerprints collide, for tests.
    """
    work = work or Work(docs.sparkSession)
    normal = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_text(F.col("text")).alias("body"))
        .withColumn("fp", F.shiftleft(F.xxhash64("body"), 64 - fp_bits))
        .withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256))
    )
    keys = work.table(normal.select("doc_id", "fp", "text_sha256"), "exact-keys")
    segment_bits = max(0, math.ceil(math.log2(max(1, keys.count() / SEGMENT_ROWS))))
    merged = work.table(merge_filters(build_filters(keys, segment_bits)), "exact-filters")
    many = work.table(repeated_prints(merged), "exact-repeated").select("fp")
    # the rows on their way to verification, text included
    routed = work.table(normal.join(many, "fp"), "exact-routed", "zstd")
    first = routed.groupBy("fp", "text_sha256").agg(F.min_by("body", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("other"))
    checked = (
        routed.join(first, ["fp", "text_sha256"])
        # a text that differs in spite of equal hashes makes a group of its own
        .withColumn("apart", F.when(F.col("body") != F.col("other"), F.col("body")))
        .select("doc_id", "fp", "text_sha256", "apart")
        .withColumn("row", F.monotonically_increasing_id())
    )
    checked = work.table(checked, "exact-checked")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    group = checked.groupBy("fp", "text_sha256", "apart").agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
    c, g = checked.alias("c"), group.alias("g")
    same = (
        (F.col("c.fp") == F.col("g.fp"))
        & (F.col("c.text_sha256") == F.col("g.text_sha256"))
        & F.col("c.apart").eqNullSafe(F.col("g.apart"))
    )
    copies = c.join(g, same).select(
        "c.doc_id",
        F.col("g.first.doc_id").alias("keep_id"),
        "g.group_size",
        (F.col("c.row") == F.col("g.first.row")).alias("kept"),
        "c.text_sha256",
    )
    single = keys.join(many, "fp", "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(copies)
