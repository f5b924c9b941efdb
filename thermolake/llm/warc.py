"""WARC archives as seekable Zstandard bundles.

Records (WARC/1.1) are grouped into frames that decompress independently; the file ends with a
skippable frame holding the seek table of the Zstandard seekable format (compressed and
decompressed size of every frame), so any zstd tool still reads the whole archive. An index maps
each record to (file, frame, offset inside the frame, length): reading one record takes the seek
table, one range of the file and one frame.

Of records with equal payloads, the one with the smallest id is a ``response``; the others are
``revisit`` records that refer to it and carry no payload. Only ids and digests are joined by digest; per digest, partial
aggregation leaves a row per task, however common a payload is.

Defined cases: a null payload is empty; a null url is written as an empty target; a record whose id
is null is always a response, and so are all rows that share the smallest id of a payload; other
columns are ignored; an empty table gives no files and no rows; a payload longer than a frame's
target has a frame to itself.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import open_file, prepare, shared_path, stored, write_file

# Uncompressed bytes after which a frame is closed, and compressed bytes after which a file is.
FRAME_BYTES = 256 << 10
FILE_BYTES = 64 << 20
LEVEL = 3

# Fixed values of the formats: the skippable frame of the seek table, its closing number.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"

INDEX_DDL = "record_id bigint, path string, frame int, offset bigint, length bigint"


def base32(sha1: str) -> str:
    """Bare upper-case base32 of a SHA-1 in hex; its 160 bits need no padding."""
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def record(record_id: int | None, url: str, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record: headers, payload (none for a revisit), and the closing blank lines."""
    name = lambda key: f"<urn:x-record:{key}>"
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name('' if record_id is None else record_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base32(sha1)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {name(refers_to)}")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of the record that ``data`` starts with."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start, size = end + 4, int(headers["Content-Length"])
    if data[start + size : start + size + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return headers, data[start : start + size]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *frame) for frame in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Bundle:
    """Random access to the frames of an archive."""

    def __init__(self, path: str):
        self.file = open_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, number = struct.unpack("<IBI", self.file.read(9))
        if number != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * count)
        table = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.starts, self.sizes, at = [], table, 0
        for compressed, _ in table:
            self.starts.append(at)
            at += compressed
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.held[0] != number:
            compressed, size = self.sizes[number]
            self.file.seek(self.starts[number])
            self.held = (number, zstandard.ZstdDecompressor().decompress(self.file.read(compressed), max_output_size=size))
        return self.held[1]

    def record(self, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return parse(self.frame(frame)[offset : offset + length])


def with_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``sha1`` (hex) and ``refers_to`` to rows (record_id, url, payload).

    Payloads are shuffled by record id only; what is joined by digest is (id, digest).
    """
    keyed = records.withColumn("sha1", F.sha1("payload"))
    narrow = keyed.filter(F.octet_length("payload") >= min_bytes).select("record_id", "sha1")
    groups = (
        narrow.groupBy("sha1")
        .agg(F.min("record_id").alias("refers_to"), F.max("record_id").alias("last_id"))
        .filter("refers_to < last_id")
        .select("sha1", "refers_to")
    )
    revisits = stored(narrow.join(groups, "sha1").filter("record_id > refers_to").distinct(), "warc-revisits")
    return keyed.join(revisits, ["record_id", "sha1"], "left")


def write(pages: DataFrame, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (record_id, url, payload) rows as archives; returns the index of all records.

    A task holds one file. A repeated task writes files of its own; only those named in the committed index
    count.
    """
    spark = prepare(pages.sparkSession)
    folder = shared_path(spark, "warc")
    rows = pages.select(
        F.col("record_id").cast("bigint"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        part, seq = TaskContext.get().partitionId(), 0
        done, frames, index, held, size, total = [], [], [], [], 0, 0

        def close_frame() -> None:
            nonlocal held, size, total
            if held:
                data = b"".join(held)
                packed = compress(data)
                done.append(packed)
                frames.append((len(packed), len(data)))
                held, size, total = [], 0, total + len(packed)

        def close_file() -> pa.RecordBatch:
            path = write_file(folder, f"records-{part:06d}-{seq:04d}", b"".join(done) + seek_table(frames))
            ids, frame, offset, length = zip(*index)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([path] * len(ids)), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                ["record_id", "path", "frame", "offset", "length"],
            )

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("record_id", "url", "payload", "sha1", "refers_to")]
            for row in zip(*columns):
                data = record(*row)
                if held and size + len(data) > frame_bytes:
                    close_frame()
                index.append((row[0], len(frames), size, len(data)))
                held.append(data)
                size += len(data)
                if total >= file_bytes:
                    close_frame()
                    yield close_file()
                    done, frames, index, total, seq = [], [], [], 0, seq + 1
        close_frame()
        if index:
            yield close_file()

    marked = with_revisits(rows, min_bytes).select("record_id", "url", "payload", "sha1", "refers_to")
    return stored(marked.mapInArrow(run, INDEX_DDL), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """Records of an index, each fetched by its place: headers of use and the body.

    Frames are spread by (file, frame) over as many tasks as there are files, as the index is too small to
    tell Spark what reading them takes; a task opens a file once for its run of frames.
    """
    prepare(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, bundle = None, None
        for batch in batches:
            out = []
            for record_id, name, *place in zip(*(batch[c].to_pylist() for c in ("record_id", "path", "frame", "offset", "length"))):
                if name != path:
                    if bundle:
                        bundle.file.close()
                    path, bundle = name, Bundle(name)
                headers, body = bundle.record(*place)
                refers = headers.get("WARC-Refers-To")
                sha1 = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if refers is None and base32(hashlib.sha1(body).hexdigest()) != sha1:
                    raise ValueError(f"record {record_id} in {name} does not match its digest")
                out.append((record_id, headers["WARC-Type"], headers["WARC-Target-URI"], int(headers["WARC-Payload-Length"]), sha1, refers and int(refers[14:-1]), body))
                if len(out) == 256:
                    yield to_batch(out)
                    out = []
            if out:
                yield to_batch(out)

    schema = pa.schema(
        [("record_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("body", pa.binary())]
    )

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)

    ddl = "record_id bigint, record_type string, url string, payload_bytes bigint, payload_digest string, refers_to bigint, body binary"
    files = max(1, index.select("path").distinct().count())
    placed = index.repartition(files, "path", "frame").sortWithinPartitions("path", "frame", "offset")
    return placed.mapInArrow(run, ddl)
