"""Quality by compression: which of two dictionaries shortens a text more.

One zstandard dictionary is built from good labelled texts, one from bad ones. A text is cut into
blocks, every block is compressed alone with either dictionary (in one long frame a dictionary
would only help at its start), and

    x = (bytes with the bad dictionary - bytes with the good one) / half their sum

becomes a probability by a logistic curve. The dictionaries come from one half of the labelled
texts, the curve from the other, weighted to the true numbers of good and bad labels. All labelled
texts take part: tasks make dictionaries of bounded parts, and of these the next ones.

Defined cases: null and empty texts have x = 0; rows with a null label or text are not learned
from; without labels of both kinds every text scores the share of label 1 (0.5 without any);
repeated rows are scored each; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import TEXTS_PER_PART, each_part, in_order, labelled_parts, packed, prepare, stored

# Dictionaries of parts that one is made of.
MERGED = 16
# Steps of a measure that the curve tells apart, in a unit; with one part there are few texts.
CELLS, CELLS_OF_ONE = 1 << 12, 1 << 40
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 512
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def measure(self, texts: list[str | None]) -> np.ndarray:
        return measure(self.good, self.bad, texts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.measure(texts) + self.intercept, -30, 30)))


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)


def blocks(text: str) -> Iterator[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    for at in range(0, len(data), BLOCK_BYTES):
        yield data[at : at + BLOCK_BYTES]


def measure(good: bytes, bad: bytes, texts: list[str | None]) -> np.ndarray:
    """The normalised difference of compressed sizes per text; 0 for an empty one."""
    if not (good and bad):
        return np.zeros(len(texts))
    with_good, with_bad = compressor(good).compress, compressor(bad).compress
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        g = b = 0
        for block in blocks(text or ""):
            g += len(with_good(block))
            b += len(with_bad(block))
        if g + b:
            out[i] = 2 * (b - g) / (g + b)
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50, texts: np.ndarray | None = None) -> tuple[float, float]:
    """Weighted logistic curve by Newton steps, with a small ridge on the standardised slope. A row
    stands for so many ``texts``, one by default."""
    spread = np.sqrt(np.average((x - np.average(x, weights=texts)) ** 2, weights=texts))
    centre, spread = np.average(x, weights=weight), max(1e-9, float(spread))
    z = np.stack([(x - centre) / spread, np.ones(len(x))])
    theta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(theta @ z, -30, 30)))
        gradient = z @ (weight * (p - y)) + [1e-3 * theta[0], 0]
        curvature = (z * (weight * p * (1 - p))) @ z.T + np.diag([1e-3, 1e-9])
        theta -= np.clip(np.linalg.solve(curvature, gradient), -2, 2)
    return float(theta[0] / spread), float(theta[1] - theta[0] * centre / spread)


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    return dictionary_of([block for text in texts for block in blocks(text)], size)


def dictionary_of(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    size = min(size, sum(map(len, samples)) // 4)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for training: the texts themselves
        return b"".join(samples)[:DICTIONARY_BYTES]


PACKED = "part bigint, bad array<string>, good array<string>"


def pack(part: pa.Table) -> pa.Table:
    """A part's texts by label: every other one makes the dictionary, the rest the curve."""
    own = in_order(part)
    texts = [own.filter(pc.equal(own["label"], label))["text"].to_pylist() for label in (0, 1)]
    return pa.table({"part": part["part"][:1], "bad": pa.array([texts[0]], pa.list_(pa.string())), "good": pa.array([texts[1]], pa.list_(pa.string()))})


def dictionaries(rows: DataFrame, parts: int) -> dict[int, bytes]:
    """A dictionary per label: one from each part's texts, then from those of up to ``MERGED`` parts one,
    until one is left."""

    def first(part: dict) -> pa.Table:
        return pa.table({"label": [0, 1], "part": [part["part"]] * 2, "data": [dictionary(part[x][::2]) for x in ("bad", "good")]})

    def merged(some: pa.Table) -> pa.Table:
        some = some.sort_by("part")
        data = some["data"].to_pylist()
        samples = [d[at : at + BLOCK_BYTES] for d in data for at in range(0, len(d), BLOCK_BYTES)]
        data = dictionary_of(samples) if len(data) > 1 else data[0]
        return pa.table({"label": some["label"][:1], "part": some["part"][:1], "data": [data]})

    ddl = "label bigint, part bigint, data binary"
    made = stored(each_part(rows, first, ddl), "dictionaries")
    step = 1
    while step < parts:
        step *= MERGED
        group = (F.col("part") / step).cast("bigint")
        made = stored(made.groupBy("label", group).applyInArrow(lambda t: merged(t), ddl), "dictionaries")
    return {r["label"]: bytes(r["data"]) for r in made.collect()}  # two rows


def fit(docs: DataFrame, labels: DataFrame, per_part: int = TEXTS_PER_PART) -> QualityModel:
    """Fit on all documents with rows (doc_id, label), part by part."""
    counts, rows, parts = labelled_parts(docs.select("doc_id", "text"), labels, per_part)
    total = sum(counts.values())
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        share = counts.get(1, 0) / total if total else 0.5
        return QualityModel(b"", b"", 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rows, steps = packed(rows, pack, PACKED), CELLS_OF_ONE if parts == 1 else CELLS
    made = dictionaries(rows, parts)
    shared = docs.sparkSession.sparkContext.broadcast((made[1], made[0]))

    def measured(part: dict) -> pa.Table:
        found = [(label, measure(*shared.value, part[x][1::2])) for label, x in enumerate(("bad", "good"))]
        cells = np.concatenate([np.rint(x * steps) for _, x in found]).astype(np.int64)
        return pa.table({"label": np.concatenate([np.full(len(x), y) for y, x in found]), "cell": cells})

    # A row per cell of measures between -2 and 2 and label.
    cells = each_part(rows, measured, "label bigint, cell bigint")
    found = cells.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "cell").toArrow()
    shared.destroy()
    x, y, n = found["cell"].to_numpy() / steps, found["label"].to_numpy().astype(float), found["n"].to_numpy()
    weight = n * np.where(y == 1, counts[1] / max(1, (n * y).sum()), counts[0] / max(1, (n * (1 - y)).sum())) / total
    slope, intercept = logistic(x, y, weight * n.sum(), texts=n)
    return QualityModel(made[1], made[0], slope, intercept)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and ``score``, the probability of label 1, from the whole text alone."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(shared.value.score(batch["text"].to_pylist()))], ["doc_id", "score"]
            )

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id bigint, score double")
