"""Token ids in files of directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits, the lowest in level 0. Level k holds the k-th
chunk of every id that has one, in order. A bitmap per level says whether an id goes on in the
next level, and a rank directory (ones before each 64-bit word) turns its position there into one
lookup and one population count. Any id is read from one byte per level, without decoding others.

File (little-endian): magic, then int64 fields (chunk bits, levels, ids, documents), then the
sections, each at a multiple of 8 bytes: per level its length, chunks, bitmap and directory; then
document ids, one byte per document that is 1 for a null id, and first positions.

Defined cases: null texts are empty and hold only the end id; null document ids come first; rows
with equal ids are ordered by text; an empty table gives no files and no rows; other columns are
ignored; a document of any length is one run of ids (files are closed between documents).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import open_file, prepare, shared_path, stored, write_file
from thermolake.llm.tokens import encoder

MAGIC = b"TOKDAC01"
CHUNK_BITS = 8
# A file is closed after the document that reaches this many ids (10 MB or so).
FILE_IDS = 4_000_000
# Ids read in one piece when documents are read back; their arrays stay in a core's cache.
READ_IDS = 1 << 16

MANIFEST_DDL = "part int, seq int, path string, documents bigint, ids bigint"


def _section(array: np.ndarray) -> bytes:
    data = array.tobytes()
    return data + b"\0" * (-len(data) % 8)


def encode(ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> bytes:
    """One file: all ids, the documents they belong to, and the first position of each."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunks = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint32(CHUNK_BITS)
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        words = np.frombuffer(_section(bits), "<u8")
        ones = np.cumsum(np.bitwise_count(words), dtype="<i8")
        levels.append([np.array([len(chunks)], "<i8"), chunks, words, np.concatenate([np.zeros(1, "<i8"), ones])])
        rest = rest[goes_on]
        if not len(rest):
            break
    head = np.array([CHUNK_BITS, len(levels), len(ids), len(doc_ids)], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], "<i8")
    sections = [head, *(a for level in levels for a in level), known, null, starts.astype("<i8")]
    return MAGIC + b"".join(map(_section, sections))


class DacFile:
    """Random access to a file's ids."""

    def __init__(self, data: bytes | pa.Buffer):
        self.data = memoryview(data)
        if bytes(self.data[:8]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.at = 8
        self.chunk_bits, levels, self.n_ids, self.n_docs = self._take("<i8", 4).tolist()
        self.levels = []
        for _ in range(levels):
            n = int(self._take("<i8", 1)[0])
            words = -(-n // 64)
            self.levels.append((self._take("u1", n), self._take("<u8", words), self._take("<i8", words + 1)))
        self.doc_ids = self._take("<i8", self.n_docs)
        self.null_ids = self._take("u1", self.n_docs).astype(bool)
        self.starts = self._take("<i8", self.n_docs)

    def _take(self, kind: str, count: int) -> np.ndarray:
        kind = np.dtype(kind)
        out = np.frombuffer(self.data, kind, count, self.at)
        self.at += -(-count * kind.itemsize // 8) * 8
        return out

    def take(self, positions: np.ndarray) -> np.ndarray:
        """The ids at these positions, in any order."""
        at = np.asarray(positions, np.int64)
        out = np.zeros(len(at), np.uint32)
        rows = np.arange(len(at))
        for level, (chunks, words, ranks) in enumerate(self.levels):
            out[rows] |= chunks[at].astype(np.uint32) << np.uint32(self.chunk_bits * level)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            bits = words[word]
            goes_on = (bits >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
            at = (ranks[word] + below)[goes_on].astype(np.int64)
            rows = rows[goes_on]
            if not len(rows):
                break
        return out

    def span(self, start: int, end: int) -> np.ndarray:
        """The ids from one position to another: in every level they are neighbours, too."""
        out = np.zeros(end - start, np.uint32)
        rows: np.ndarray | slice = slice(None)
        for level, (chunks, words, ranks) in enumerate(self.levels):
            out[rows] |= chunks[start:end].astype(np.uint32) << np.uint32(self.chunk_bits * level)
            first = start >> 6
            bits = np.unpackbits(words[first : -(-end // 64)].view(np.uint8), bitorder="little")
            goes_on = bits[start - 64 * first : end - 64 * first].view(bool)
            below = np.bitwise_count(words[first] & np.uint64((1 << (start & 63)) - 1)) if start & 63 else 0
            rows = np.flatnonzero(goes_on) if level == 0 else rows[goes_on]
            if not len(rows):
                break
            start = int(ranks[first] + below)
            end = start + len(rows)
        return out

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, by its place in the file."""
        end = self.starts[number + 1] if number + 1 < self.n_docs else self.n_ids
        return self.span(int(self.starts[number]), int(end))


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the manifest of the files.

    The documents are range partitioned, so files follow the order of ids. A task keeps one file's
    ids in memory. A repeated task writes files of its own; only those that the committed
    manifest names count.
    """
    spark = prepare(docs.sparkSession)
    folder = shared_path(spark, "dac")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer).encode
        part, seq, held, keys, starts, at = TaskContext.get().partitionId(), 0, [], [], [], 0
        end = np.array([end_id], "<u4")

        def close() -> pa.RecordBatch:
            path = write_file(folder, f"ids-{part:06d}-{seq:04d}", encode(np.concatenate(held), keys, np.array(starts)))
            row = [[part], [seq], [path], [len(keys)], [at]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "seq", "path", "documents", "ids"])

        for batch in batches:
            for key, ids in zip(batch["doc_id"].to_pylist(), encode_texts(batch["text"])):
                keys.append(key)
                starts.append(at)
                held += [ids, end]
                at += len(ids) + 1
                if at >= file_ids:
                    yield close()
                    held, keys, starts, at, seq = [], [], [], 0, seq + 1
        if keys:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ordered.mapInArrow(run, MANIFEST_DDL), "dac-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Documents read back: doc_id, start over all files, n_tokens, and ids as binary.

    The running sum is over the manifest, one row per file; ids are read file by file.
    """
    prepare(manifest.sparkSession)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first")), "dac-files")
    count = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch["path"].to_pylist(), batch["first"].to_pylist()):
                with open_file(path) as source:
                    dac = DacFile(source.read_buffer())
                ends = np.append(dac.starts[1:], dac.n_ids)
                a = 0
                while a < dac.n_docs:  # whole documents, about READ_IDS ids at a time
                    b = max(a + 1, int(np.searchsorted(ends, dac.starts[a] + READ_IDS)))
                    ids = dac.span(int(dac.starts[a]), int(ends[b - 1]))
                    spans = [ids[s:e].tobytes() for s, e in zip(dac.starts[a:b] - dac.starts[a], ends[a:b] - dac.starts[a])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(dac.doc_ids[a:b], mask=dac.null_ids[a:b]),
                            pa.array(dac.starts[a:b] + first),
                            pa.array(ends[a:b] - dac.starts[a:b]),
                            pa.array(spans, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    a = b

    spread = files.repartition(count, "path") if count > 1 else files
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
