"""What the operators share: stored intermediates, files in the shared folder, words and folds."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake.session import checkpoint_dir

# What an Arrow batch sent to a Python worker may weigh: texts differ in length by thousands.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes, so that very long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/thermolake-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows as Parquet into the shared folder and read them back: lineage ends here."""
    spark = rows.sparkSession
    path = shared_path(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write one file; its name is unique per attempt, so a repeated task harms nothing.

    Only files named in a committed manifest count; a lost attempt leaves an unused file.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    full = f"{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{path}/{full}") as out:
        out.write(data)
    return f"{folder}/{full}"


def write_once(folder: str, name: str, data: bytes) -> str:
    """Write a file whose bytes do not depend on the attempt, under a name that readers can derive.

    It appears whole or not at all; a repeated task finds it there or puts an equal one in its place.
    """
    full = write_file(folder, f"part-{name}", data)
    fs, source = pafs.FileSystem.from_uri(full)
    target = f"{folder}/{name}"
    place = pafs.FileSystem.from_uri(target)[1]
    try:
        fs.move(source, place)
    except OSError:  # some file systems do not replace a file
        if not file_exists(target):
            raise
        fs.delete_file(source)
    return target


def file_exists(uri: str) -> bool:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.get_file_info(path).type == pafs.FileType.File


def open_file(uri: str) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased, cut at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64, public constants)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; with fewer words, of the whole sequence as one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - width + 1 + i]
    return mix(out + np.uint64(width))


@dataclass
class WordTable:
    """Words of many texts: the distinct ones, a number per word, and the words of each text."""

    distinct: list[str]
    codes: np.ndarray
    counts: np.ndarray

    def places(self, counts: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """First place of each text, and the place of every word, when each text has ``counts``
        places and ``gap`` empty ones behind them."""
        starts = np.cumsum(counts + gap) - (counts + gap)
        return starts, np.arange(len(self.codes)) + np.repeat(starts - (np.cumsum(self.counts) - self.counts), self.counts)


def word_table(texts: list[str | None] | pa.Array) -> WordTable:
    """Runs of letters and digits, lower-cased, of whole texts; a null text has none."""
    lower = pc.utf8_lower(pc.fill_null(pa.array(texts, pa.large_string()), ""))
    split = pc.split_pattern_regex(lower, r"[^\p{L}\p{N}]+")
    ends = split.offsets.to_numpy() - (split.offsets[0].as_py() if len(split.offsets) else 0)
    flat = split.flatten().dictionary_encode()
    distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
    codes = flat.indices.to_numpy().astype(np.int64)
    real = codes != (distinct.index("") if "" in distinct else -1)
    before = np.concatenate([[0], np.cumsum(real)])
    return WordTable(distinct, codes[real], before[ends[1:]] - before[ends[:-1]])


# Labelled texts that one task fits on.
TEXTS_PER_PART = 4_096


def labelled_parts(docs: DataFrame, labels: DataFrame, per_part: int) -> tuple[dict[int, int], DataFrame, int]:
    """Numbers of documents with label 0 and 1, and all of these documents with their ``label`` and the
    ``part`` that they belong to, by a hash of id and text; and the number of parts of about ``per_part``.

    ``labels`` has (doc_id, label). A null text has no part.
    """
    named = docs.filter("text is not null")
    known = labels.filter("label in (0, 1)").select("doc_id", "label")
    # Repeated labels count, but show a text once.
    # Written first, so that Spark knows their size and leaves the texts in place if it can.
    known = stored(known.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("times")), "known")
    rows = stored(named.join(known, "doc_id"), "labelled")
    found = rows.groupBy("label").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    parts = max(1, math.ceil(sum(r["rows"] for r in found) / per_part))
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(parts)).cast("bigint")
    return {r["label"]: r["n"] for r in found}, rows.withColumns({"part": part, "place": F.xxhash64("doc_id")}), parts


def packed(rows: DataFrame, make: Callable[[pa.Table], pa.Table], ddl: str) -> DataFrame:
    """One stored row per part, so that later passes over the parts shuffle nothing."""
    return stored(rows.groupBy("part").applyInArrow(lambda t: make(t), ddl), "packed")


def each_part(parts: DataFrame, run: Callable[[dict], pa.Table], ddl: str) -> DataFrame:
    """What ``run`` makes of every packed part."""

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from run(batch.slice(at, 1).to_pylist()[0]).to_batches()

    return parts.mapInArrow(parts_of, ddl)


def in_order(part: pa.Table) -> pa.Table:
    """Rows of a part by label, then by a hash of the id."""
    return part.sort_by([(c, "ascending") for c in ("label", "place", "doc_id", "text")])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
