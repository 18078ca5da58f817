"""WARC archives in seekable Zstandard bundles.

Records are compressed in independent frames of several records. A bundle is a file of frames that ends
with a seek table, a skippable frame that lists the compressed and the full size of every frame, as in
the seekable format of the Zstandard repository. The index maps each record to its bundle, its frame and
its place in the full frame, so one record is read by decompressing one frame.

Every task writes its bundles under names of its own and returns their index rows; only bundles of
tasks that ended well are in the index table, so a task that is run again, or lost halfway,
leaves at most a file that nothing refers to. Bundles go to a folder that all executors share, through its file system's own library.

Of records with equal payloads of at least ``min_revisit_bytes`` bytes, that with the largest id is a response
with the payload, and the others are revisits that refer to it and keep only the HTTP header.

Defined results: a null html is an empty payload; null urls are written as an empty target; rows without page_id are
responses if no row with one has the same payload; repeated rows of the largest id are all responses; an empty table has no
bundles. Whole pages are kept, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace, shared_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
LEVEL = 3
#: Fixed values of the seekable format: magic numbers of the skippable frame and of the footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame long, frame_start long, frame_bytes long, offset long, bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


class Archive(NamedTuple):
    folder: str
    index: DataFrame


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple]:
    """Fields of RECORD of each record in ``data``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        size = int(head["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
        is_revisit = head["WARC-Type"] == "revisit"
        yield _page_id(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Type"], _page_id(head.get("WARC-Refers-To")), head[
            "WARC-Payload-Digest"
        ].removeprefix("sha1:"), length, None if is_revisit else payload
        at = end + 4 + size + 4


def _page_id(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


class Bundle:
    """Frames of records, written one after the other."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.start = 0
        self.frame = bytearray()
        self.entries: list[tuple] = []  # of the frame
        self.index: list[tuple] = []

    def add(self, page_id: int | None, data: bytes) -> None:
        self.entries.append((page_id, len(self.frame), len(data)))
        self.frame += data
        if len(self.frame) >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.frame:
            return
        packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(bytes(self.frame))
        number = len(self.sizes)
        self.index += [(page_id, number, self.start, len(packed), offset, size) for page_id, offset, size in self.entries]
        self.parts.append(packed)
        self.sizes.append((len(packed), len(self.frame)))
        self.start += len(packed)
        self.frame, self.entries = bytearray(), []

    def finished(self) -> bytes:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = table + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.parts) + struct.pack("<II", SKIPPABLE, len(footer)) + footer


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """Start, compressed and full size of each frame, read from the end of the bundle."""
    number, descriptor, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or descriptor & 0x80:
        raise ValueError("no seek table without checksums at the end")
    table = bundle[-9 - 8 * number : -9]
    frames, start = [], 0
    for packed, full in struct.iter_unpack("<II", table):
        frames.append((start, packed, full))
        start += packed
    return frames


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archive(pages: DataFrame, min_revisit_bytes: int = 0, work: Workspace | None = None) -> Archive:
    """Bundles of all ``pages`` (page_id, url, html), and the index of their records."""
    spark = pages.sparkSession
    work = work or Workspace(spark)
    name = f"warc-{uuid.uuid4().hex[:8]}"
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.withColumn("hash", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    shared = rows.filter(F.col("size") >= min_revisit_bytes).groupBy("hash", "size").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("times"))
    shared, _ = work.write(f"{name}-shared", shared.filter("times > 1 AND kept IS NOT NULL").drop("times"))
    decided = rows.join(shared, ["hash", "size"], "left").select("page_id", "url", "payload", "kept")
    folder = f"{shared_folder(spark)}/{name}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        bundle = Bundle()

        def store() -> pa.RecordBatch:
            file = f"bundle-{uuid.uuid4().hex}.warc.zst"
            data = bundle.finished()
            with system.open_output_stream(f"{path}/{file}", compression=None) as out:
                out.write(data)
            columns = list(zip(*bundle.index, strict=True))
            arrays = [pa.array(columns[0], pa.int64()), pa.array([file] * len(columns[0])), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=["page_id", "bundle", "frame", "frame_start", "frame_bytes", "offset", "bytes"])

        for batch in batches:
            for page_id, url, payload, kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = kept is not None and kept != page_id
                bundle.add(page_id, record(page_id, url, payload, kept, revisit))
                if bundle.start >= BUNDLE_BYTES:
                    yield store()
                    bundle = Bundle()
        if bundle.frame or bundle.sizes:
            yield store()

    index, _ = work.write(f"{name}-index", decided.mapInArrow(write, INDEX))
    return Archive(folder, index)


def read_archive(archive: Archive) -> DataFrame:
    """All records of the archive's bundles, frame by frame."""
    folder = archive.folder
    frames = archive.index.select("bundle", "frame").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        for batch in batches:
            wanted: dict[str, list[int]] = {}
            for file, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted.setdefault(file, []).append(frame)
            for file, numbers in wanted.items():
                with system.open_input_file(f"{path}/{file}") as source:
                    table = _seek_table_of(source)
                    for number in sorted(numbers):
                        start, packed, full = table[number]
                        yield _records(zstandard.ZstdDecompressor().decompress(source.read_at(packed, start), max_output_size=full))

    return frames.mapInArrow(read, RECORD)


def _seek_table_of(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    size = source.size()
    number = struct.unpack("<IBI", source.read_at(9, size - 9))[0]
    return seek_table(source.read_at(9 + 8 * number, size - 9 - 8 * number))


def _records(data: bytes) -> pa.RecordBatch:
    columns = list(zip(*parse(data), strict=True))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_records(archive: Archive, page_ids: DataFrame) -> DataFrame:
    """The records of some ``page_ids``, each cut out of its one frame."""
    folder = archive.folder
    places = archive.index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi").select("bundle", "frame_start", "frame_bytes", "offset", "bytes")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        for batch in batches:
            for file, start, packed, offset, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_file(f"{path}/{file}") as source:
                    frame = zstandard.ZstdDecompressor().decompress(source.read_at(packed, start))
                yield _records(frame[offset : offset + size])

    return places.mapInArrow(read, RECORD)
