"""Interpolated modified Kneser-Ney language model over hashed n-grams.

Counting: the most frequent words, at most ``COMMON_WORDS`` of them, are numbered by falling
frequency. A task numbers the rarer words it sees behind them, counts n-grams of these numbers, and
deals the sorted counts into buckets by a hash of the context (the words before the last one). A row
of a bucket has the hashes of its rarer words once and its n-grams as columns of steps between sorted
numbers, cut into byte planes and compressed. The numbers only shorten what travels: rare and common words count alike. A bucket sums its rows, so that it has all n-grams of its
contexts. It writes one file of sorted hash arrays, and passes on, for the next shorter order, in how
many different contexts each shorter n-gram was seen (its continuation count). These counts travel to
the next order's buckets once and are stored nowhere else; the sums of a finished order go along with
them. The number of buckets follows the size of the corpus; files are named by
order and bucket, and nothing but sums over the corpus returns to the driver.

A file of order 2 and above holds 48-bit hashes of its n-grams as a directory of the upper 16 bits
and a sorted array of the lower 32, their counts, and in the same form its contexts, each with the number of
its kind: a kind is a total and how many n-grams have a count of 1, 2, and 3 or more, so contexts seen
once are all of one kind. Counts and kinds take a byte each; the few that need more are kept apart, and
the kinds of most contexts have the lowest numbers. A file of order 1 has sorted 64-bit word hashes with continuation and plain
counts, in the same bytes. Workers map the files into memory and look up the n-grams of many texts at a time, bucket by
bucket; a bucket without n-grams has no file.

Probability of a word w after a context h, from the longest order down:

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + gamma(h) * p(w | h without its first word)

with three discounts per order from the counts of counts; contexts never seen pass on to the
shorter one; below order 1 lies the uniform distribution over all words and one unknown.

Defined cases: null and empty texts have one token, the end; rows with a null id or text outside the
training set are scored alike; repeated rows are counted and scored each; without training texts
every token has probability 1; long texts are whole; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import file_exists, mix, open_file, prepare, shared_path, word_hashes, words, write_once

ORDER = 3
# Training text per bucket, which bounds a bucket's group and file.
BUCKET_BYTES = 16 << 20
# N-grams that a task counts before it sends them on.
HELD_TOKENS = 4_000_000
# Words that are looked up at a time.
PIECE = 1 << 18
# Files that a worker keeps mapped.
OPEN_FILES = 4096
# Counts and kinds from here on are kept apart in a file.
LARGE = 0xFF

# No word contains a space.
BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"begin of text"))
END = np.uint64(xxhash.xxh3_64_intdigest(b"end of text"))

# A row has counts (data) or the sums of a bucket that is done (stats).
COUNTS_DDL = "bucket int, data binary, level int, stats array<bigint>"
COUNTS_SCHEMA = pa.schema([("bucket", pa.int32()), ("data", pa.binary()), ("level", pa.int32()), ("stats", pa.list_(pa.int64()))])
# Tasks that merge buckets; beyond that a task has several buckets, one after the other.
MERGE_TASKS = 16_384
# Words with a number of their own: 8 MB of hashes, whatever the corpus.
COMMON_WORDS = 1 << 20


def marked_words(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts with their markers, the places of the tokens, and tokens per text."""
    hashes = [word_hashes(words(text)) for text in texts]
    sizes = np.array([len(h) + 1 for h in hashes], np.int64)
    pads = order - 1
    begin, end = np.full(pads, BEGIN), np.array([END])
    flat = np.concatenate([part for h in hashes for part in (begin, h, end)]) if hashes else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes + pads)
    return flat, np.arange(sizes.sum()) + np.repeat(ends - np.cumsum(sizes), sizes), sizes


def context_hash(nearest_first: list[np.ndarray]) -> np.ndarray:
    out = nearest_first[0]
    for word in nearest_first[1:]:
        out = mix(out * np.uint64(31) + word)
    return out


def n_grams(texts: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Contexts, words and the number of tokens of each text.

    Context j (from 0) is a hash of the j + 1 words before a word; texts begin with markers.
    """
    flat, at, sizes = marked_words(texts, order)
    contexts: list[np.ndarray] = []
    for j in range(order - 1):
        word = flat[at - j - 1]
        contexts.append(context_hash([contexts[-1], word]) if contexts else word)
    return contexts, flat[at], sizes


def group_sorted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by these keys (the last one first), and where each group of equal keys starts."""
    order = np.lexsort(keys)
    change = np.zeros(len(order), bool)
    change[:1] = True
    for key in keys:
        ranked = key[order]
        change[1:] |= ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(change)


def equal_rows(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by these columns of numbers below ``size``, and where each group of equal rows starts."""
    bits = max(1, (size - 1).bit_length())
    if bits * len(columns) > 64:
        return group_sorted(*reversed(columns))
    key = columns[0].astype(np.uint64)
    for column in columns[1:]:
        key = key << np.uint64(bits) | column.astype(np.uint64)
    order = np.argsort(key)
    ranked, change = key[order], np.ones(len(order), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=change[1:])
    return order, np.flatnonzero(change)


class Numbering:
    """Numbers of words: those of the common ones, then those of the rarer ones at hand."""

    def __init__(self, common: np.ndarray):
        self.common, self.rank = common, np.argsort(common)
        self.sorted = common[self.rank]

    def of_texts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rarer words, and the number of every word."""
        distinct = np.unique(hashes)
        at = np.minimum(np.searchsorted(self.sorted, distinct), max(0, len(self.sorted) - 1))
        known = self.sorted[at] == distinct if len(self.sorted) else np.zeros(len(distinct), bool)
        numbers = np.empty(len(distinct), np.int32)
        numbers[known] = self.rank[at[known]]
        numbers[~known] = len(self.common) + np.arange(int((~known).sum()))
        out = np.empty(len(hashes), np.int32)
        for a in range(0, len(hashes), PIECE):  # an index of all words at once would be the largest array here
            out[a : a + PIECE] = numbers[np.searchsorted(distinct, hashes[a : a + PIECE])]
        return distinct[~known], out

    def of_rows(self, rarer: list[np.ndarray], columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rarer words of several rows together, and each row's numbers (any columns, joined) among them."""
        together, inverse = np.unique(np.concatenate(rarer), return_inverse=True)
        own, first = np.split(inverse, np.cumsum([len(r) for r in rarer])[:-1]), len(self.common)
        out = []
        for column, to in zip(columns, own):
            column = column.astype(np.int32)
            rare = column >= first
            column[rare] = first + to[column[rare] - first]
            out.append(column)
        return together, out

    def hashes(self, rarer: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        first = len(self.common)
        if not first:
            return rarer[numbers]
        out = self.common[np.minimum(numbers, first - 1)]
        rare = numbers >= first
        out[rare] = rarer[numbers[rare] - first]
        return out

    def row(self, rarer: np.ndarray, columns: list[np.ndarray], n: np.ndarray, plain: np.ndarray) -> bytes:
        """Sorted n-grams as bytes, with the hashes of the rarer words they use."""
        first = len(self.common)
        used = np.unique(np.concatenate([c[c >= first] for c in columns]))
        columns = [np.where(c >= first, first + np.searchsorted(used, c), c) for c in columns]
        return compressed([ascending(rarer[used - first]), *steps(columns), n, plain])


def common_words(docs: DataFrame, order: int, buckets: int) -> np.ndarray:
    """Hashes of the most frequent words, markers included, by falling frequency (ties: by hash).

    A task's counts travel like n-grams, in buckets by the upper bits of the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = ((word >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            bounds = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield counts_row(int(bucket[a]), data=compressed([ascending(word[a:b]), n[a:b]]))

        for batch in batches:
            held.append(marked_words(batch["text"].to_pylist(), order)[0])
            tokens += len(held[-1])
            if tokens >= HELD_TOKENS:
                yield from flush()
                held, tokens = [], 0
        if tokens:
            yield from flush()

    def summed(group: pa.Table) -> pa.Table:
        word, n = (np.concatenate(c) for c in zip(*map(arrays, group["data"].to_pylist())))
        order, first = group_sorted(word)
        return pa.table({"word": word[order[first]].view(np.int64), "n": np.add.reduceat(n[order], first, dtype=np.int64)})

    counts = docs.select("text").mapInArrow(run, COUNTS_DDL).groupBy("bucket").applyInArrow(summed, "word bigint, n bigint")
    top = counts.orderBy(F.desc("n"), "word").limit(COMMON_WORDS).select("word").toArrow()
    return top["word"].to_numpy().view(np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as planes of their lowest, second, ... bytes, as many as the largest needs."""
    wide = values.astype("<u8")
    width = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    return struct.pack("<qb", len(wide), width) + wide.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def compressed(values: list[np.ndarray]) -> bytes:
    return zstandard.compress(b"".join(map(planes, values)), 3)


def ascending(hashes: np.ndarray) -> np.ndarray:
    """Steps between sorted hashes."""
    return np.diff(hashes, prepend=np.uint64(0))


def arrays(data: bytes) -> list[np.ndarray]:
    """What was compressed: hashes first, then other numbers."""
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        count, width = struct.unpack_from("<qb", raw, at)
        at += 9
        wide = np.zeros((count, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count).T
        values = wide.view("<u8")[:, 0]
        out.append(values.astype(np.int64 if width > 3 else np.int32) if out else np.cumsum(values))
        at += count * width
    return out


def unpacked(data: bytes) -> list[np.ndarray]:
    """Hashes of rarer words, columns, counts and plain counts."""
    out = arrays(data)
    return [out[0], *from_steps(out[1:-2]), *out[-2:]]


def steps(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted rows of numbers: the step from the row before where all earlier columns stay equal, else the number."""
    same, out = np.arange(len(columns[0])) > 0, []
    for column in columns:
        step = np.diff(column, prepend=0)
        out.append(np.where(same, step, column))
        same = same & (step == 0)
    return out


def from_steps(columns: list[np.ndarray]) -> list[np.ndarray]:
    same, out = np.arange(len(columns[0])) > 0, []
    for step in columns:
        sums, whole = np.cumsum(step), np.flatnonzero(~same)
        before = np.repeat(sums[whole] - step[whole], np.diff(whole, append=len(step)))
        out.append((sums - before).astype(np.int32))
        same = same & (step == 0)
    return out


def deal(buckets: int, numbering: Numbering, rarer: np.ndarray, columns: list[np.ndarray], n: np.ndarray, plain: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted counts as one row per bucket. Columns: the words before, nearest first, and the word."""
    owner = context_hash([numbering.hashes(rarer, c) for c in columns[:-1] or columns])
    bucket = (owner % np.uint64(buckets)).astype(np.int32)
    del owner
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = order[a:b]
        yield counts_row(int(bucket[own[0]]), data=numbering.row(rarer, [c[own] for c in columns], n[own], plain[own]))


def counts_row(bucket: int, data: bytes | None = None, level: int | None = None, stats: list[int] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((bucket, data, level, stats), COUNTS_SCHEMA)], schema=COUNTS_SCHEMA)


def counted(docs: DataFrame, order: int, buckets: int, common: Broadcast) -> DataFrame:
    """N-gram counts of the texts, summed within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(common.value)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        tokens = places = 0

        def flush() -> Iterator[pa.RecordBatch]:
            flat, at = np.concatenate([flat for flat, _ in held]), np.concatenate([at for _, at in held])
            held.clear()
            rarer, numbers = numbering.of_texts(flat)
            del flat
            columns = [*(numbers[at - j] for j in range(1, order)), numbers[at]]
            del at, numbers
            rank, first = equal_rows(columns, len(numbering.common) + len(rarer))
            n = np.diff(first, append=len(rank))
            first = rank[first]
            del rank
            columns = [c[first] for c in columns]
            del first
            yield from deal(buckets, numbering, rarer, columns, n, n)

        for batch in batches:
            flat, at, _ = marked_words(batch["text"].to_pylist(), order)
            held.append((flat, (at + places).astype(np.int32)))
            places += len(flat)
            tokens += len(at)
            if tokens >= HELD_TOKENS:
                yield from flush()
                tokens = places = 0
        if tokens:
            yield from flush()

    return docs.select("text").mapInArrow(run, COUNTS_DDL)


def section(array: np.ndarray) -> bytes:
    data = array.tobytes()
    return np.array([len(array)], "<i8").tobytes() + data + b"\0" * (-len(data) % 8)


class HashFile:
    """The arrays of a file, without copying them."""

    KINDS = {
        1: ("<u8", "<u1", "<u4", "<u8", "<u1", "<u4", "<u8"),
        2: ("<u4", "<u4", "<u1", "<u4", "<u8", "<u4", "<u4", "<u1", "<u4", "<u8", "<u8", "<u4", "<u4", "<u4"),
    }

    def __init__(self, path: str, level: int):
        place = urlparse(path)
        if place.scheme in ("", "file"):
            data = np.memmap(place.path, np.uint8, "r")
        else:  # the shared folder is no mounted one
            with open_file(path) as source:
                data = np.frombuffer(source.read_buffer(), np.uint8)
        self.arrays, at = [], 0
        for kind in self.KINDS[min(level, 2)]:
            size, count = np.dtype(kind).itemsize, int(data[at : at + 8].view("<i8")[0])
            self.arrays.append(data[at + 8 : at + 8 + size * count].view(kind))
            at += 8 + -(-size * count // 8) * 8

    def words(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Continuation and plain counts; 0 for an unknown word."""
        known, *counts = self.arrays
        at = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
        hit = known[at] == word
        n, plain = (np.where(hit, self.numbers(at, *c), 0) for c in (counts[:3], counts[3:]))
        return n, plain

    @staticmethod
    def places(directory: np.ndarray, lower: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys, by a search between two entries of the directory, and which were found."""
        part = (key >> np.uint64(48)).astype(np.int64)
        value = (key >> np.uint64(16)).astype(np.uint32)
        low, high = directory[part].astype(np.int64), directory[part + 1].astype(np.int64)
        end = high.copy()
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            open_ = low < high
            middle = (low + high) >> 1
            less = open_ & (lower[np.minimum(middle, len(lower) - 1)] < value)
            low = np.where(less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        at = np.minimum(low, len(lower) - 1)
        return at, (low < end) & (lower[at] == value)

    @staticmethod
    def numbers(at: np.ndarray, small: np.ndarray, large_at: np.ndarray, large: np.ndarray) -> np.ndarray:
        """Whole numbers at these places, see ``small_and_large``."""
        out = small[at].astype(np.int64)
        big = np.flatnonzero(out == LARGE)
        out[big] = large[np.searchsorted(large_at, at[big])]
        return out

    def counts(self, key: np.ndarray) -> np.ndarray:
        """Counts of n-grams by their hash."""
        directory, lower, *counts = self.arrays[:5]
        at, hit = self.places(directory, lower, key)
        return np.where(hit, self.numbers(at, *counts), 0)

    def contexts(self, context: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Total per context (0 if unknown) and its n-grams with counts 1, 2, and 3 or more."""
        directory, lower, *which, total, k1, k2, k3 = self.arrays[5:]
        at, hit = self.places(directory, lower, mix(context))
        which, kinds = self.numbers(at, *which), (k1, k2, k3)
        return np.where(hit, total[which], 0).astype(np.int64), [np.where(hit, k[which], 0) for k in kinds]


def key_of(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def hash_arrays(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directory of the upper 16 bits of sorted keys, and the next 32."""
    return np.searchsorted(key >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)), (key >> np.uint64(16)).astype("<u4")


def context_kinds(total: np.ndarray, kinds: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of each context's kind and the table of kinds: kind 0 is that of a total of 1, then by falling frequency."""
    which = np.zeros(len(total), np.int64)
    more = np.flatnonzero(total > 1)
    values = [np.asarray(v)[more] for v in (total, *kinds)]
    order, first = group_sorted(*values)
    n = np.diff(first, append=len(order))
    frequent = np.argsort(-n, kind="stable")
    which[more[order]] = np.repeat(1 + np.argsort(frequent), n)
    return which, [np.concatenate([[one], v[order[first[frequent]]]]) for one, v in zip((1, 1, 0, 0), values)]


def small_and_large(values: np.ndarray) -> list[np.ndarray]:
    """A byte per whole number, and the places and values of those that do not fit."""
    large = np.flatnonzero(values >= LARGE)
    return [np.minimum(values, LARGE), large, values[large]]


def longer_file(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> bytes:
    key = key_of(context, word)
    order = np.argsort(key)
    arrays = [*hash_arrays(key[order]), *small_and_large(n[order])]
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    key = mix(context[starts])
    which, table = context_kinds(np.add.reduceat(n, starts), [np.add.reduceat(k, starts, dtype=np.int64) for k in (n == 1, n == 2, n >= 3)])
    order = np.argsort(key)
    arrays += [*hash_arrays(key[order]), *small_and_large(which[order]), *table]
    return b"".join(section(a.astype(kind)) for a, kind in zip(arrays, HashFile.KINDS[2]))


def file_name(level: int, bucket: int) -> str:
    return f"order{level}-{bucket:09d}"


def merged(level: int, buckets: int, folder: str, common: Broadcast):
    """Sum a bucket's counts of this order, write its file, and count for the next shorter order.

    Sums of the longer orders are passed on.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        longer = [counts_row(**r) for r in group.select(["bucket", "level", "stats"]).to_pylist() if r["stats"]]
        parts = [unpacked(data) for data in group["data"].drop_null().to_pylist()]
        if not parts:
            return pa.Table.from_batches(longer, COUNTS_SCHEMA)
        numbering = Numbering(common.value)
        rarer, joined = numbering.of_rows([p[0] for p in parts], [np.concatenate(p[1 : level + 1]) for p in parts])
        cut = [np.split(column, level) for column in joined]
        columns = [np.concatenate([c[j] for c in cut]) for j in range(level)]
        n, plain = (np.concatenate([p[j] for p in parts]) for j in (level + 1, level + 2))
        del parts, joined, cut
        size = len(numbering.common) + len(rarer)
        order, first = equal_rows(columns, size)
        n, plain = np.add.reduceat(n[order], first, dtype=np.int64), np.add.reduceat(plain[order], first, dtype=np.int64)
        columns = [c[order[first]] for c in columns]
        word = numbering.hashes(rarer, columns[-1])
        if level == 1:
            order = np.argsort(word)
            values = [word[order], *small_and_large(n[order]), *small_and_large(plain[order])]
            data = b"".join(section(a.astype(kind)) for a, kind in zip(values, HashFile.KINDS[1]))
            rows = []
        else:
            data = longer_file(context_hash([numbering.hashes(rarer, c) for c in columns[:-1]]), word, n)
            shorter = [*columns[: level - 2], columns[-1]]
            order, first = equal_rows(shorter, size)
            seen = np.diff(first, append=len(order))
            rows = list(deal(buckets, numbering, rarer, [c[order[first]] for c in shorter], seen, np.add.reduceat(plain[order], first)))
        write_once(folder, file_name(level, bucket), data)
        stats = [*((n == c).sum() for c in (1, 2, 3, 4)), len(n), n.sum(), plain.sum()]
        return pa.Table.from_batches([*rows, *longer, counts_row(bucket, level=level, stats=[int(v) for v in stats])], COUNTS_SCHEMA)

    return run


@dataclass(frozen=True)
class Model:
    """Where the files are, and sums over the corpus; of one size for any corpus."""

    buckets: int
    folder: str
    discounts: dict[int, tuple[float, float, float]]
    first_kinds: tuple[int, int, int]
    first_total: int
    vocabulary: int
    tokens: int
    order: int


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from counts of counts; fixed ones if these are too few."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), float(i + 1)) for i, d in enumerate(found))


def train(docs: DataFrame, order: int = ORDER, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Count the whole texts of these rows."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark = prepare(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    folder = shared_path(spark, "language-model")
    common = spark.sparkContext.broadcast(common_words(docs, order, buckets))
    rows = counted(docs, order, buckets, common)
    for level in range(order, 0, -1):
        spread = rows.repartition(min(buckets, MERGE_TASKS), "bucket")
        rows = spread.groupBy("bucket").applyInArrow(merged(level, buckets, folder, common), COUNTS_DDL)
    # One run over all orders: what is left are the sums of every bucket and order.
    of_corpus = rows.groupBy("level").agg(*[F.sum(F.col("stats")[i]) for i in range(7)]).collect()
    sums = {level: np.zeros(7, np.int64) for level in range(1, order + 1)} | {r[0]: np.array(r[1:], np.int64) for r in of_corpus}
    common.destroy()
    one, two, _, _, vocabulary, total, tokens = sums[1].tolist()
    return Model(
        buckets,
        folder,
        {level: discounts(*s[:4].tolist()) for level, s in sums.items()},
        (one, two, vocabulary - one - two),
        total,
        vocabulary,
        tokens,
        order,
    )


@lru_cache(maxsize=1)
def mapped(folder: str) -> dict[tuple[int, int], HashFile | None]:
    """The open files of one model; those of another are let go."""
    return {}


def hash_file(folder: str, level: int, bucket: int) -> HashFile | None:
    files, key = mapped(folder), (level, bucket)
    if key not in files:
        if len(files) >= OPEN_FILES:
            files.clear()
        path = f"{folder}/{file_name(level, bucket)}"
        files[key] = HashFile(path, level) if file_exists(path) else None
    return files[key]


def by_bucket(model: Model, level: int, key: np.ndarray) -> Iterator[tuple[HashFile, np.ndarray]]:
    """The file of each bucket and the places of the keys that belong to it."""
    bucket = key % np.uint64(model.buckets)
    bucket = bucket.astype(np.uint16 if model.buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(model.buckets + 1))
    for number in np.flatnonzero(np.diff(bounds)):
        file = hash_file(model.folder, level, int(number))
        if file:
            yield file, order[bounds[number] : bounds[number + 1]]


def probabilities(model: Model, contexts: list[np.ndarray], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability and plain training count of each word."""
    n, plain = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
    for file, at in by_bucket(model, 1, word):
        n[at], plain[at] = file.words(word[at])

    def discounted(level: int, count: np.ndarray) -> np.ndarray:
        off = np.array([0.0, *model.discounts[level]])[np.minimum(count, 3)]
        return np.maximum(count - off, 0)

    p = np.full(len(word), 1 / (model.vocabulary + 1))
    if model.first_total:
        spare = sum(d * k for d, k in zip(model.discounts[1], model.first_kinds)) / model.first_total
        p = discounted(1, n) / model.first_total + spare * p
    for level in range(2, model.order + 1):
        context = contexts[level - 2]
        for file, at in by_bucket(model, level, context):
            total, kinds = file.contexts(context[at])
            count = file.counts(key_of(context[at], word[at]))
            seen = total > 0
            at, total, count = at[seen], total[seen], count[seen]
            spare = sum(d * k[seen] for d, k in zip(model.discounts[level], kinds))
            p[at] = (discounted(level, count) + spare * p[at]) / total
    return p, plain


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, tokens, known tokens, base score and log10 probability of every whole text."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            contexts, word, sizes = n_grams(batch["text"].to_pylist(), own.order)
            p, plain = probabilities(own, contexts, word)
            starts = np.cumsum(sizes) - sizes
            base = np.log10((plain + 1) / (own.tokens + own.vocabulary + 1))
            values = [sizes, np.add.reduceat((plain > 0).astype(np.int64), starts), np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, values)], schema=pa.schema(kinds))

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
