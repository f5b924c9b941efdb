"""Quality and toxicity: held-out accuracy, folds, and defined cases."""

import math
import zlib

import numpy as np
import pytest
import regex
import xxhash
import zstandard
from pyspark.sql import functions as F

from thermolake.llm import quality, toxicity
from thermolake.llm.common import labelled_parts
from thermolake.llm.queries import known_labels, op2_toxicity, op7_quality

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    ones = labels == 1
    return (order[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


def held_out_rows(spark, query, label, folds, fold):
    rows = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % folds == fold)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.7)
    known = [r for r in rows if r["held_out"] and r[label] is not None]
    return np.array([r["score"] for r in known]), np.array([r[label] for r in known])


def test_quality_on_held_out_texts(spark):
    scores, labels = held_out_rows(spark, op7_quality, "quality", 4, 2)
    assert auc(scores, labels) >= 0.93
    assert (scores[labels == 1] >= 0.7).mean() >= 0.95 and (scores[labels == 0] < 0.7).mean() >= 0.75


def test_toxicity_on_held_out_texts(spark):
    scores, labels = held_out_rows(spark, op2_toxicity, "toxic", 3, 1)
    assert auc(scores, labels) >= 0.95
    assert (scores[labels == 0] < 0.7).mean() >= 0.98 and (scores[labels == 1] >= 0.7).mean() >= 0.7


def test_the_held_out_fold_is_not_learned_from(spark, sf_dir):
    used = {r["doc_id"] for r in known_labels(spark, sf_dir, "toxic", 3, 1).collect()}
    assert used and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in used)


LABELLED = "doc_id bigint, text string, lang string, label int"


def fit_on(spark, fit, rows):
    frame = spark.createDataFrame(rows, LABELLED)
    return fit(frame.drop("label"), frame.select("doc_id", "label"))


def rows_of(n):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice([*"aeioutrnsl"], 4))
    out = []
    for i in range(n):
        text = [word() for _ in range(40)]
        if i % 2:
            text[int(rng.integers(40))] = "zzbad"
        out.append((i, " ".join(text), "en" if i % 3 else None, i % 2))
    return out


@pytest.mark.parametrize("fit,score", [(quality.fit, quality.score), (toxicity.fit, toxicity.score)])
@pytest.mark.parametrize("rows,expected", [([], None), ([(i, "a b", "en", 1) for i in range(8)], 1.0), ([(1, "a", None, 0)] * 8, 0.0), ([(1, None, None, 1), (2, "a", None, None)], None)])
def test_without_both_labels_all_score_the_share(spark, odd_docs, fit, score, rows, expected):
    model = fit_on(spark, fit, rows)
    if expected is None:
        expected = 0.5 if fit is quality.fit else 0.0
    scores = [r["score"] for r in score(odd_docs.drop("score"), model).collect()]
    assert len(scores) == odd_docs.count() and all(abs(s - expected) < 1e-6 for s in scores)


@pytest.mark.parametrize("fit,score", [(quality.fit, quality.score), (toxicity.fit, toxicity.score)])
def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, fit, score):
    model = fit_on(spark, fit, rows_of(60))
    rows = score(odd_docs, model).select("doc_id", "score").collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert score(no_docs, model).count() == 0


def test_a_window_does_not_change_a_score(monkeypatch):
    texts = [row[1] for row in rows_of(30)] + ["", None, "one"]
    words = toxicity.hashed(texts)
    net = toxicity.train(words, np.array([row[3] for row in rows_of(30)] + [0, 0, 0], float), epochs=3)
    whole = net.logits(words)
    alone = np.array([net.logits(toxicity.hashed([t]))[0] for t in texts])
    monkeypatch.setattr(toxicity, "WINDOW", 7)
    assert np.allclose(net.logits(words), whole, atol=1e-4) and np.allclose(alone, whole, atol=1e-4)
    assert auc(whole[:30], np.array([row[3] for row in rows_of(30)])) == 1.0


def test_thresholds_reach_the_precision():
    scores, toxic = np.array([0.9, 0.8, 0.8, 0.5, 0.4]), np.array([1, 1, 1, 0, 1])
    assert toxicity.lowest_threshold(scores, toxic, np.ones(5)) == 0.65
    assert toxicity.lowest_threshold(scores, 1 - toxic, np.ones(5)) > 1


def test_language_decides_the_threshold_only(spark):
    model = toxicity.ToxicityModel(None, 0.0, 0.0, 0.5, {"en": 0.25})
    docs = spark.createDataFrame([("en",), ("xx",), (None,)], "lang string")
    assert [r[0] for r in docs.select(toxicity.threshold(model, F.col("lang"))).collect()] == [0.25, 0.5, 0.5]


def test_logistic_recovers_a_curve():
    x = np.linspace(-4, 4, 4_000)
    y = (np.random.default_rng(0).random(4_000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, intercept = quality.logistic(x, y, np.ones(4_000))
    assert math.isclose(slope, 2, abs_tol=0.25) and math.isclose(intercept, -1, abs_tol=0.25)


def calibration(on_top):
    """Two languages of 100 and 650 toxic texts; so many texts of the small one that are not toxic score highest."""
    rng = np.random.default_rng(4)
    groups = [("aa", 1, 100, 0.6, 0.95), ("bb", 1, 650, 0.6, 0.95), ("aa", 0, 100, 0.01, 0.4), ("bb", 0, 650, 0.01, 0.4)]
    parts = [(rng.uniform(a, b, n), np.full(n, y, float), np.full(n, lang, object)) for lang, y, n, a, b in groups]
    scores, toxic, langs = (np.concatenate(c) for c in zip(*parts))
    scores[750 : 750 + on_top] = 0.96 + 0.01 * np.arange(on_top)
    return scores, toxic, np.where(toxic == 1, 1.0, 8.0), langs


@pytest.mark.parametrize("on_top", [0, 1, 2])
def test_single_texts_do_not_turn_rejection_off(on_top):
    scores, toxic, weight, langs = calibration(on_top)
    pooled, by_language = toxicity.thresholds(scores, toxic, weight, langs)
    own = (langs == "aa") & (toxic == 1)
    assert all(cut <= 1 for cut in by_language.values()) and pooled < 0.6
    assert (scores[own] >= by_language.get("aa", pooled)).mean() >= 0.95


def test_a_language_with_many_false_positives_rejects_less():
    scores, toxic, weight, langs = calibration(0)
    scores[750:756] = np.linspace(0.61, 0.75, 6)
    pooled, by_language = toxicity.thresholds(scores, toxic, weight, langs)
    assert by_language["aa"] > 0.7 > by_language["bb"]


def test_rejection_per_language_on_held_out_texts(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    known = op2_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").join(langs, "doc_id")
    rows = [r for r in known.filter("held_out and toxic is not null").collect()]
    for lang in {r["lang"] for r in rows}:
        rejected = np.array([r["rejected"] for r in rows if r["lang"] == lang])
        toxic = np.array([r["toxic"] for r in rows if r["lang"] == lang])
        if toxic.sum() >= 20:
            assert rejected[toxic == 1].mean() >= 0.35 and toxic[rejected].mean() >= 0.9


def test_convolution_and_pooling_word_by_word():
    """Every window of every width on its own, in plain Python, against the batched network."""
    rng = np.random.default_rng(3)
    texts = [row[1] for row in rows_of(12)] + ["", None, "one", "Zwei Wörter", "a a a a", "x, y; z!"]
    net = toxicity.Network.fresh(toxicity.hashed(texts), np.arange(len(texts)) % 2, 5)
    net.embedding[:-1] = rng.normal(size=net.embedding[:-1].shape).astype(np.float32)
    net.biases = [rng.normal(size=b.shape).astype(np.float32) for b in net.biases]
    net.bias = 0.25

    def vector(word):
        number = xxhash.xxh3_64_intdigest(word.encode())
        return net.embedding[number % toxicity.BUCKETS] + net.embedding[(number >> 32) % toxicity.BUCKETS]

    for text, found in zip(texts, net.logits(toxicity.hashed(texts))):
        words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
        rows = [vector(w) for w in words] or [np.zeros(toxicity.DIMENSIONS)]
        total = net.bias
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = -math.inf
                for at in range(len(rows)):
                    value = float(net.biases[k][f])
                    for i, row in enumerate(rows[at : at + width]):
                        value += float(row @ net.filters[k][i * toxicity.DIMENSIONS : (i + 1) * toxicity.DIMENSIONS, f])
                    best = max(best, value)
                total += max(best, 0.0) * float(net.weights[k * toxicity.FILTERS + f])
        assert abs(total - found) < 1e-3


def test_compressed_sizes_block_by_block():
    """Each block of a text by a compressor of its own."""
    texts = [row[1] for row in rows_of(20)] + ["", None, "é" * 700, "x" * 512, "y" * 513]
    good, bad = (quality.dictionary([row[1] for row in rows_of(40)][part::2]) for part in (0, 1))

    def size(dictionary, block):
        data = zstandard.ZstdCompressionDict(dictionary)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(dict_data=data, level=quality.LEVEL, **options).compress(block))

    for text, found in zip(texts, quality.measure(good, bad, texts)):
        data = (text or "").encode()
        blocks = [data[i : i + quality.BLOCK_BYTES] for i in range(0, len(data), quality.BLOCK_BYTES)]
        g, b = (sum(size(d, block) for block in blocks) for d in (good, bad))
        assert found == pytest.approx(2 * (b - g) / (g + b) if blocks else 0.0)


def test_all_labelled_texts_take_part(spark):
    """More than a task fits on, in parts of bounded size; each text is in one of them."""
    rows = [(i, f"text {i}", "en", i % 2) for i in range(9_000)]
    frame = spark.createDataFrame(rows, LABELLED)
    counts, found, parts = labelled_parts(frame.drop("label"), frame.select("doc_id", "label"), 1_000)
    sizes = [r["count"] for r in found.groupBy("part").count().collect()]
    assert counts == {0: 4_500, 1: 4_500} and parts == 9
    assert sum(sizes) == 9_000 and len(sizes) == 9 and max(sizes) < 1_300


@pytest.mark.parametrize("fit", [quality.fit, toxicity.fit])
def test_several_parts_make_one_model(spark, fit):
    """A word that only some parts have is learned all the same."""
    frame = spark.createDataFrame(rows_of(600), LABELLED)
    model = fit(frame.drop("label"), frame.select("doc_id", "label"), per_part=150)
    rows = rows_of(900)[600:]
    scores = np.array(model.score([row[1] for row in rows]))
    assert auc(scores, np.array([row[3] for row in rows])) > (0.99 if fit is toxicity.fit else 0.5)
