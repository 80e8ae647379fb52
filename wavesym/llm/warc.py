"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each of some whole records, then two frames that other
readers skip: the record index, which maps record ids to a frame, an offset in it and a length, and the seek
table of the seekable format, with the sizes of the frames before it. Any record can be read by reading the end
of the file and one frame.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work, make_folder, new_file, open_read, open_write

FRAME_BYTES = 1 << 19
LEAST_SHARED = 1000  # bytes; smaller payloads are stored each time
# fixed values of the formats
_SKIPPABLE_INDEX, _SKIPPABLE_SEEK, _SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return int(name) if name and name != "none" else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record; a payload that doesn't have its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


class BundleWriter:
    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.codec = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.open, self.size = [], 0
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, name: str, raw: bytes) -> None:
        self.index.append((name, len(self.frames), self.size, len(raw)))
        self.open.append(raw)
        self.size += len(raw)
        if self.size >= self.frame_bytes:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.open:
            packed = self.codec.compress(b"".join(self.open))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.open, self.size = [], 0

    def close(self) -> None:
        self._end_frame()
        index = self.codec.compress(json.dumps(self.index).encode())
        self.stream.write(struct.pack("<II", _SKIPPABLE_INDEX, len(index)) + index)
        entries = [*self.frames, (8 + len(index), 0)]
        body = b"".join(struct.pack("<II", *e) for e in entries) + struct.pack("<IBI", len(entries), 0, _SEEK_END)
        self.stream.write(struct.pack("<II", _SKIPPABLE_SEEK, len(body)) + body)
        self.stream.close()


class BundleReader:
    def __init__(self, file):
        self.file, size = file, file.size()
        n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != _SEEK_END:
            raise ValueError("not a seekable bundle")
        table = file.read_at(8 * n, size - 9 - 8 * n)
        entries = [struct.unpack_from("<II", table, 8 * k) for k in range(n)]
        self.starts = [0]
        for packed, _ in entries:
            self.starts.append(self.starts[-1] + packed)
        self.frames = entries[:-1]
        raw = file.read_at(entries[-1][0], self.starts[-2])
        self.index = json.loads(zstandard.ZstdDecompressor().decompress(raw[8:]))
        self.places: dict[str, list[int]] = {}

    def frame(self, k: int) -> bytes:
        packed, size = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, self.starts[k]), max_output_size=size)

    def record(self, name: str) -> bytes:
        """One record by its id: a frame is read, no more."""
        if not self.places:
            self.places = {name: place for name, *place in reversed(self.index)}  # the first of equal names
        frame, offset, size = self.places[name]
        return self.frame(frame)[offset : offset + size]

    def records(self) -> Iterator[bytes]:
        at, raw = -1, b""
        for _, frame, offset, size in self.index:
            if frame != at:
                at, raw = frame, self.frame(frame)
            yield raw[offset : offset + size]


INDEX = "record_id string, path string, frame int, offset long, size long"


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a bundle per task; returns the index, a row per record.

    Of records with equal payloads of LEAST_SHARED bytes or more, that with the largest page_id holds the
    payload and the others refer to it.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("sha256", F.sha2("payload", 256))
    long = rows.filter(F.octet_length("payload") >= LEAST_SHARED)
    held = long.groupBy("sha1", "sha256").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).filter("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    planned = rows.join(held, ["sha1", "sha256"], "left").select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = writer = None
        for batch in batches:
            for k in range(len(batch)):
                page, url, payload, sha1, refers_to = (c[k].as_py() for c in batch.columns)
                if writer is None:
                    path = new_file(folder, f"pages-{TaskContext.get().partitionId():08d}", ".warc.zst")
                    writer = BundleWriter(open_write(path))
                writer.add(_urn(page), record(page, url, payload, sha1, refers_to))
        if writer is not None:
            writer.close()
            for low in range(0, len(writer.index), 10_000):
                names, frames, offsets, sizes = zip(*writer.index[low : low + 10_000])
                columns = [pa.array(names), pa.array([path] * len(names)), pa.array(frames, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())],
                    ["record_id", "path", "frame", "offset", "size"],
                )

    return planned.mapInArrow(write, INDEX)


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the bundles that an index names; a task for each bundle, about."""
    names = [c for c in _FIELDS if payloads or c != "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_read(path) as file:
                    rows, size = [], 0
                    for raw in BundleReader(file).records():
                        rows.append(parse(raw))
                        size += len(raw) if payloads else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _FIELDS[c]) for c in names], names)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _FIELDS[c]) for c in names], names)

    types = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    paths = index.select("path").distinct()
    return paths.repartition(max(1, paths.count())).mapInArrow(read, ", ".join(f"{c} {types[_FIELDS[c]]}" for c in names))


def archive(pages: DataFrame, payloads: bool = True, work: Work | None = None) -> DataFrame:
    """Writes the bundles to the shared folder and reads every record back.

    page_id, url, payload_bytes, payload_digest (hex SHA-1), record_type, refers_to, payload (null for revisits).
    Null html is an empty payload; a null url is empty. A row without an id has a record of its own and refers
    to the holder like others, but holds a payload for others never. Rows that repeat the holder's id are all
    responses. Empty tables write nothing. Other columns are not read.
    """
    work = work or Work(pages.sparkSession)
    folder = work.folder("bundles")
    make_folder(folder)
    return read_bundles(work.table(write_bundles(pages, folder), "record-index"), payloads)
