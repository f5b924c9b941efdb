"""Toxicity by a convolutional text classifier, trained in numpy.

A word (a run of letters and digits, lower-cased) has the sum of two hashed embeddings, so that
words share a vector only if both hashes agree. Embeddings start from the evidence of their buckets. Filters of several widths run over the whole text,
each keeps its largest value (max pooling), and a linear layer gives a logit. All labelled texts
are used, in parts that a task trains on: it starts from the common network, and what parts learned
is averaged, an embedding over the parts that have its words. A quarter of each part is kept for
calibration. A logistic curve, fitted on labelled texts that the network did not learn from and weighted to the true numbers of
labels, turns it into a probability.

Thresholds for rejecting are calibrated per language on the same texts: the lowest score at which
``PRECISION`` of what is rejected is toxic. A language's precision is shrunk towards the one of all
languages, so that no single text moves it by more than ``1 - PRECISION``. The threshold of all
languages serves where a language has too few toxic examples or no score that reaches the precision.
Language decides the threshold only, never the score.

Defined cases: null and empty texts, and texts without a word, score as one without any signal; rows with a null
label or text are not learned from; without labels of both kinds every text scores the share of
label 1 (0 without any); an unknown or null language takes the pooled threshold; repeated rows are
scored each; null ids are kept; other columns are ignored; long texts are read whole, in windows
that overlap by the widest filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import TEXTS_PER_PART, each_part, in_order, labelled_parts, packed, prepare, stored, word_hashes, word_table
from thermolake.llm.quality import logistic

BUCKETS = 1 << 17
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
# Averages over the networks of several parts.
ROUNDS = 3
# Tasks that average them, and steps of a logit that the calibration tells apart, in a unit; with one
# part there are few texts.
AVERAGING = 32
CELLS, CELLS_OF_ONE = 1 << 10, 1 << 40
BATCH = 32
RATE = 0.01
# Word positions convolved at a time.
WINDOW = 1 << 15
# What a threshold must reach, and the toxic texts a language needs for one of its own.
PRECISION = 0.97
LEAST_EXAMPLES = 25

GAP = max(WIDTHS) - 1
# Texts of a part hashed at a time.
PART = 256


@dataclass
class Words:
    """Bucket pairs of many texts, one after the other, each followed by ``GAP`` empty places (-1).

    A text without words is one empty place.
    """

    pairs: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    def of(self, texts: np.ndarray) -> Words:
        """The same for some of the texts."""
        size = self.counts[texts] + GAP
        ends = np.cumsum(size)
        rows = np.arange(ends[-1]) + np.repeat(self.starts[texts] - (ends - size), size)
        return Words(self.pairs[rows], ends - size, self.counts[texts])

    @classmethod
    def hashed(cls, texts: list[str | None]) -> Words:
        """Many texts, a part of them at a time, so that the words themselves are not all held."""
        parts = [hashed(texts[at : at + PART]) for at in range(0, len(texts), PART)]
        counts = np.concatenate([p.counts for p in parts])
        starts = np.cumsum(counts + GAP) - (counts + GAP)
        return cls(np.concatenate([p.pairs for p in parts]), starts, counts)


def hashed(texts: list[str | None]) -> Words:
    """Words of whole texts; each distinct word of the batch is hashed once."""
    words = word_table(texts)
    hashes = word_hashes([w.encode() for w in words.distinct])
    low, high = hashes % np.uint64(BUCKETS), (hashes >> np.uint64(32)) % np.uint64(BUCKETS)
    table = np.concatenate([np.stack([low, high], 1).astype(np.int32), np.full((1, 2), -1, np.int32)])
    counts = np.maximum(words.counts, 1)
    starts, places = words.places(counts, GAP)
    place = np.full(int((counts + GAP).sum()), len(hashes), np.int64)
    place[places] = words.codes
    return Words(table[place], starts, counts)


def evidence(words: Words, labels: np.ndarray) -> np.ndarray:
    """Texts of label 0 and 1 that have each bucket, counted once per bucket of a word's pair."""
    seen = np.zeros((2, BUCKETS))
    for start, count, label in zip(words.starts, words.counts, labels):
        for pair in (0, 1):
            bucket = np.unique(words.pairs[start : start + count, pair])
            seen[int(label), bucket[bucket >= 0]] += 1
    return seen


@dataclass
class Network:
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float

    @classmethod
    def fresh(cls, words: Words, labels: np.ndarray, seed: int) -> Network:
        """Random weights, save that dimension 0 of an embedding starts from its bucket's evidence:
        the log-odds that texts with it are toxic, less two standard errors, if that is positive."""
        return cls.starting(evidence(words, labels), labels, seed)

    @classmethod
    def starting(cls, seen: np.ndarray, labels: np.ndarray, seed: int) -> Network:
        """``fresh`` from the numbers of texts with each bucket, by label."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        net = cls(
            draw(BUCKETS + 1, DIMENSIONS, scale=0.1),
            [draw(w * DIMENSIONS, FILTERS, scale=(w * DIMENSIONS) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(FILTERS * len(WIDTHS), scale=0.3),
            0.0,
        )
        totals = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
        odds = np.log((seen + 0.5) / (totals + 1))
        sure = odds[1] - odds[0] - 2 * np.sqrt(1 / (seen[0] + 0.5) + 1 / (seen[1] + 0.5))
        net.embedding[:-1, 0] = np.maximum(sure, 0)
        net.embedding[-1] = 0  # the empty place, where -1 points
        for filters in net.filters:
            filters[0] = np.abs(filters[0])
        net.weights[:] = np.abs(net.weights)
        return net

    @property
    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.biases, self.weights]

    def copy(self) -> Network:
        return Network(self.embedding.copy(), [f.copy() for f in self.filters], [b.copy() for b in self.biases], self.weights.copy(), self.bias)

    def vectors(self, pairs: np.ndarray) -> np.ndarray:
        return self.embedding[pairs[:, 0]] + self.embedding[pairs[:, 1]]

    def convolved(self, x: np.ndarray, k: int) -> np.ndarray:
        """Values of the k-th filter width at every place of x but the last ``GAP``."""
        n, width = len(x) - GAP, WIDTHS[k]
        neighbours = np.concatenate([x[i : i + n] for i in range(width)], 1)
        return neighbours @ self.filters[k] + self.biases[k]

    def logits(self, words: Words) -> np.ndarray:
        """Whole texts, a window at a time; windows overlap by the widest filter."""
        best = np.full((len(words.starts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        ends = words.starts + words.counts
        for at in range(0, len(words.pairs), WINDOW):
            part = words.pairs[at : at + WINDOW + GAP]
            if len(part) <= GAP:
                break
            to = at + len(part) - GAP
            x = self.vectors(part)
            texts = np.flatnonzero((words.starts < to) & (ends > at))
            # Segments of texts and of the gaps between them, in turn.
            bounds = np.stack([np.maximum(words.starts[texts], at), np.minimum(ends[texts], to)], 1).ravel() - at
            inside = bounds < to - at
            for k in range(len(WIDTHS)):
                top = np.maximum.reduceat(self.convolved(x, k), bounds[inside], 0)[::2]
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                best[texts, own] = np.maximum(best[texts, own], top)
        return np.maximum(best, 0) @ self.weights + np.float32(self.bias)


class Adam:
    def __init__(self, shape: tuple[int, ...]):
        self.m, self.v = np.zeros(shape, np.float32), np.zeros(shape, np.float32)

    def step(self, value: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        """One update; ``rows`` limits it to those that have a gradient."""
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * gradient
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * gradient * gradient
        value[rows] -= RATE * self.m[rows] / (np.sqrt(self.v[rows]) + 1e-6)


def train(words: Words, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1, net: Network | None = None) -> Network:
    """Mini-batches with the labels weighted to balance; only pooled places carry a gradient. A given
    network is trained further, in place."""
    net, rng = net or Network.fresh(words, labels, seed), np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    parts = [net.embedding, *net.filters, *net.biases, net.weights]
    moments = [Adam(p.shape) for p in parts]
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            own = words.of(chosen)
            x = net.vectors(own.pairs)
            tops, places = [], []
            for k in range(len(WIDTHS)):
                values = net.convolved(x, k)
                place = np.stack([s + values[s : s + n].argmax(0) for s, n in zip(own.starts, own.counts)])
                places.append(place)
                tops.append(np.maximum(np.take_along_axis(values, place, 0), 0))
            top = np.concatenate(tops, 1)
            p = 1 / (1 + np.exp(-np.clip(top @ net.weights + net.bias, -30, 30)))
            slope = ((p - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            back = slope[:, None] * net.weights * (top > 0)
            grads = [None] * len(WIDTHS) * 2 + [slope @ top]
            buckets, flows = [], []
            for k, width in enumerate(WIDTHS):
                own_back = back[:, k * FILTERS : (k + 1) * FILTERS]
                rows = places[k][:, :, None] + np.arange(width)
                seen = x[rows].reshape(*places[k].shape, -1)
                grads[k] = np.einsum("df,dfj->jf", own_back, seen)
                grads[len(WIDTHS) + k] = own_back.sum(0)
                flow = (own_back[:, :, None] * net.filters[k].T[None]).reshape(-1, DIMENSIONS)
                for pair in (0, 1):
                    buckets.append(own.pairs[rows.ravel(), pair])
                    flows.append(flow)
            bucket, flow = np.concatenate(buckets), np.concatenate(flows)
            live = (bucket >= 0) & flow.any(1)
            if live.any():
                by = np.argsort(bucket[live], kind="stable")
                touched, first = np.unique(bucket[live][by], return_index=True)
                moments[0].step(net.embedding, np.add.reduceat(flow[live][by], first, 0), touched)
            net.bias -= RATE * float(slope.sum())
            for moment, part, grad in zip(moments[1:], parts[1:], grads):
                moment.step(part, grad)
    return net


@dataclass
class ToxicityModel:
    network: Network | None
    slope: float
    intercept: float
    threshold: float = 1.1
    by_language: dict[str, float] = field(default_factory=dict)

    def score(self, texts: list[str | None]) -> np.ndarray:
        logits = self.network.logits(hashed(texts)) if self.network and texts else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.intercept, -30, 30)))


def lowest_threshold(
    scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray, prior: np.ndarray | float = 0.0, strength: float = 0.0
) -> float:
    """The lowest threshold at which rejected texts are toxic at the asked precision.

    It lies midway between two scores, so rounding decides nothing; ties are rejected together. It
    is above 1 if no score reaches the precision. ``prior`` is the precision expected when the texts
    from a score on are rejected, and counts like a weight of ``strength``.
    """
    order = np.argsort(-scores, kind="stable")
    scores, toxic, weight = scores[order], toxic[order], weight[order]
    expected = np.broadcast_to(prior, order.shape)[order]
    precision = (np.cumsum(toxic * weight) + strength * expected) / (np.cumsum(weight) + strength)
    last = np.append(scores[1:] != scores[:-1], True)
    good = np.flatnonzero((precision >= PRECISION) & last & (scores > 0))
    return float(scores[good[-1]] + np.append(scores, 0)[good[-1] + 1]) / 2 if len(good) else 1.1


def thresholds(
    scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray, langs: np.ndarray, texts: np.ndarray | float = 1.0
) -> tuple[float, dict[str, float]]:
    """The threshold of all languages, and those of languages that have one of their own. A row stands
    for so many ``texts``; ``weight`` is that of all of them."""
    pooled, by_language = lowest_threshold(scores, toxic, weight), {}
    order = np.argsort(scores, kind="stable")
    above = lambda values: np.cumsum(values[order][::-1])[::-1]
    precision = above(toxic * weight) / above(weight)
    # Precision of all texts that score as much as each text or more.
    prior = precision[np.searchsorted(scores[order], scores, side="left")]
    strength = (weight / texts).max() / (1 - PRECISION)
    examples = [label * texts for label in (1 - toxic, toxic)]
    for lang in {x for x in langs if x is not None}:
        own = langs == lang
        if min(n[own].sum() for n in examples) >= LEAST_EXAMPLES:
            found = lowest_threshold(scores[own], toxic[own], weight[own], prior[own], strength)
            if found <= 1:
                by_language[lang] = found
    return pooled, by_language


@dataclass
class Part:
    """The labelled texts of one part: three quarters to train on, one to calibrate with."""

    words: Words
    labels: np.ndarray
    langs: np.ndarray
    held: np.ndarray

    DDL = "part bigint, pairs binary, counts binary, labels binary, langs array<string>"

    @staticmethod
    def packed(rows: pa.Table) -> pa.Table:
        """A part's texts, hashed, as one row."""
        rows = in_order(rows)
        words = Words.hashed(rows["text"].to_pylist())
        columns = {"pairs": words.pairs.astype("<i4"), "counts": words.counts.astype("<i8"), "labels": rows["label"].to_numpy().astype("<i8")}
        langs = pa.array([rows["lang"].to_pylist()], pa.list_(pa.string()))
        return pa.table({"part": rows["part"][:1], **{n: [v.tobytes()] for n, v in columns.items()}, "langs": langs})

    @classmethod
    def of(cls, row: dict) -> Part:
        counts, labels = np.frombuffer(row["counts"], "<i8"), np.frombuffer(row["labels"], "<i8").astype(float)
        starts = np.cumsum(counts + GAP) - (counts + GAP)
        words = Words(np.frombuffer(row["pairs"], "<i4").reshape(-1, 2), starts, counts)
        return cls(words, labels, np.array(row["langs"], object), np.arange(len(labels)) % 4 == 3)

    def learned(self) -> tuple[Words, np.ndarray]:
        return self.words.of(np.flatnonzero(~self.held)), self.labels[~self.held]


def start(rows: DataFrame, seed: int = 1) -> Network:
    """The network before training, from the evidence of all parts."""

    def count(part: dict) -> pa.Table:
        words, labels = Part.of(part).learned()
        seen = np.concatenate([evidence(words, labels), np.zeros((2, 1))], axis=1)
        seen[:, -1] = (labels == 0).sum(), (labels == 1).sum()
        label, bucket = np.nonzero(seen)
        return pa.table({"label": label, "bucket": bucket, "n": seen[label, bucket].astype(np.int64)})

    ddl = "label bigint, bucket bigint, n bigint"
    counted = each_part(rows, count, ddl).groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found, seen = counted.toArrow(), np.zeros((2, BUCKETS + 1))  # at most a row per cell of ``seen``
    seen[found["label"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    return Network.starting(seen[:, :-1], np.repeat([0, 1], seen[:, -1].astype(np.int64)), seed)


def trained(rows: DataFrame, net: Network, epochs: int) -> Network:
    """One round: every part trains a copy of the network, and what they change is averaged."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(part: dict) -> pa.Table:
        before, number = shared.value, part["part"]
        after = train(*Part.of(part).learned(), epochs, 1 + number, before.copy())
        touched = np.flatnonzero((after.embedding != before.embedding).any(axis=1))
        dense = np.concatenate([p.ravel() for p in after.dense] + [[after.bias]])
        values = [v.tobytes() for v in after.embedding[touched]] + [dense.astype(np.float32).tobytes()]
        return pa.table({"part": np.full(len(values), number), "place": np.append(touched, -1), "value": values})

    def mean(some: pa.Table) -> pa.Table:
        some = some.sort_by([("place", "ascending"), ("part", "ascending")])
        place, first, n = np.unique(some["place"].to_numpy(), return_index=True, return_counts=True)
        data, values = some["value"].to_pylist(), []
        for at, size in zip(first.tolist(), n.tolist()):
            values.append(np.mean([np.frombuffer(d, np.float32) for d in data[at : at + size]], axis=0, dtype=np.float64).astype(np.float32).tobytes())
        return pa.table({"place": place, "value": values})

    made = each_part(rows, run, "part bigint, place bigint, value binary")
    found = made.groupBy(F.pmod("place", F.lit(AVERAGING))).applyInArrow(lambda t: mean(t), "place bigint, value binary").toArrow()
    shared.destroy()
    net = net.copy()
    for place, value in zip(found["place"].to_pylist(), found["value"].to_pylist()):  # a row per bucket at most
        value = np.frombuffer(value, np.float32)
        if place >= 0:
            net.embedding[place] = value
            continue
        for part in net.dense:
            part[...], value = value[: part.size].reshape(part.shape), value[part.size :]
        net.bias = float(value[0])
    return net


def calibration(rows: DataFrame, net: Network, steps: int) -> pa.Table:
    """(lang, label, cell, n): held texts of all parts by rounded logit; only languages with enough
    examples are told apart."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(part: dict) -> pa.Table:
        part = Part.of(part)
        at = np.flatnonzero(part.held)
        cells = np.rint(shared.value.logits(part.words.of(at)).astype(float) * steps).astype(np.int64) if len(at) else at
        return pa.table({"lang": pa.array(part.langs[at].tolist(), pa.string()), "label": part.labels[at].astype(np.int64), "cell": cells})

    held = stored(each_part(rows, run, "lang string, label bigint, cell bigint"), "held")
    shared.destroy()
    enough = held.groupBy("lang").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    enough = enough.filter(f"toxic >= {LEAST_EXAMPLES} AND n - toxic >= {LEAST_EXAMPLES}").select("lang", F.lit(True).alias("enough"))
    lang = F.when(F.col("enough"), F.col("lang")).alias("lang")
    cells = held.join(enough, "lang", "left").groupBy(lang, "label", "cell").agg(F.count(F.lit(1)).alias("n"))
    return cells.orderBy("label", "cell", "lang").toArrow()


def fit(docs: DataFrame, labels: DataFrame, per_part: int = TEXTS_PER_PART, epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on all documents (doc_id, text, lang) with rows (doc_id, label), part by part."""
    counts, rows, parts = labelled_parts(docs.select("doc_id", "text", "lang"), labels, per_part)
    total = sum(counts.values())
    if min(counts.get(0, 0), counts.get(1, 0)) < 4:
        share = counts.get(1, 0) / total if total else 0.0
        return ToxicityModel(None, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rows = packed(rows, Part.packed, Part.DDL)
    net, rounds = start(rows), 1 if parts == 1 else ROUNDS
    for _ in range(rounds):
        net = trained(rows, net, max(1, epochs // rounds))
    steps = CELLS_OF_ONE if parts == 1 else CELLS
    held = calibration(rows, net, steps)
    logits, y, n = held["cell"].to_numpy() / steps, held["label"].to_numpy().astype(float), held["n"].to_numpy()
    langs = np.array(held["lang"].to_pylist(), object)
    weight = n * np.where(y == 1, counts[1] / max(1, (n * y).sum()), counts[0] / max(1, (n * (1 - y)).sum())) / total * n.sum()
    slope, intercept = logistic(logits, y, weight, texts=n)
    model = ToxicityModel(net, slope, intercept)
    scores = 1 / (1 + np.exp(-np.clip(slope * logits + intercept, -30, 30)))
    model.threshold, model.by_language = thresholds(scores, y, weight, langs, n)
    return model


def threshold(model: ToxicityModel, lang: Column) -> Column:
    found = [F.when(lang == key, F.lit(value)) for key, value in sorted(model.by_language.items())]
    return F.coalesce(*found, F.lit(model.threshold))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of the documents and ``score``, from the whole text alone."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts.tolist()))

    return docs.withColumn("score", probability(F.col("text").cast("string")))
