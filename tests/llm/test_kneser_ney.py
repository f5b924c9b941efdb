"""The hashed, bucketed model against a dictionary of n-grams."""

import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from thermolake.llm import kneser_ney as K
from thermolake.llm.queries import op9_language_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + ["</s> "]


class Brute:
    def __init__(self, texts, order):
        self.order = order
        self.counts = [None, *(Counter() for _ in range(order))]
        for text in texts:
            words = ["<s> "] * (order - 1) + tokens(text)
            for i in range(order - 1, len(words)):
                self.counts[order][tuple(words[i - order + 1 : i + 1])] += 1
        self.plain = Counter()
        for gram, n in self.counts[order].items():
            self.plain[gram[-1]] += n
        for k in range(order - 1, 0, -1):
            for gram in self.counts[k + 1]:
                self.counts[k][gram[1:]] += 1
        self.total, self.kinds, self.off = [None], [None], [None]
        for k in range(1, order + 1):
            of = Counter(self.counts[k].values())
            self.off.append(K.discounts(*(of[c] for c in (1, 2, 3, 4))))
            self.total.append(Counter())
            self.kinds.append(defaultdict(lambda: [0, 0, 0]))
            for gram, n in self.counts[k].items():
                self.total[k][gram[:-1]] += n
                self.kinds[k][gram[:-1]][min(n, 3) - 1] += 1
        self.vocabulary, self.n = len(self.counts[1]), sum(self.plain.values())

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.vocabulary + 1)
        lower, total = self.p(gram[1:]), self.total[k][gram[:-1]]
        if not total:
            return lower
        n = self.counts[k][gram]
        spare = sum(d * c for d, c in zip(self.off[k], self.kinds[k][gram[:-1]]))
        return (n - (self.off[k][min(n, 3) - 1] if n else 0) + spare * lower) / total

    def score(self, text):
        words = ["<s> "] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(words[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(words)))

    def base(self, text):
        return sum(math.log10((self.plain[w] + 1) / (self.n + self.vocabulary + 1)) for w in tokens(text))


def test_query_over_the_whole_table(spark, sf_dir, some_docs):
    texts = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    brute = Brute([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2], K.ORDER)
    rows = op9_language_model(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 == 2)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens(text)), sum(brute.plain[w] > 0 for w in tokens(text)), brute.n)
        assert math.isclose(row["score"], brute.score(text), rel_tol=1e-9) and math.isclose(row["base_score"], brute.base(text), rel_tol=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_buckets_and_odd_rows(spark, odd_docs, some_docs, monkeypatch, order):
    monkeypatch.setattr(K, "HELD_TOKENS", 2_000)
    docs = some_docs.select("doc_id", "text").limit(60).cache()
    brute = Brute([r["text"] for r in docs.collect()], order)
    model = K.train(docs, order, bucket_bytes=40_000)
    assert model.buckets > 2 and model.tokens == brute.n and model.vocabulary == brute.vocabulary
    rows = K.score(docs.unionByName(odd_docs.select("doc_id", "text")), model).collect()
    assert len(rows) == docs.count() + odd_docs.count()
    expected = sorted(brute.score(r["text"]) for r in [*docs.collect(), *odd_docs.collect()])
    assert np.allclose(sorted(r["score"] for r in rows), expected, rtol=1e-9)


def test_probabilities_sum_to_one(spark):
    texts = ["a b a c", "b a b", "a a b c d", "d"]
    model = K.train(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 3)
    for context in ("a", "b", "c x", "", "zzz"):
        vocabulary = sorted({w for t in texts for w in t.split()})
        total = 0.0
        for word in [*vocabulary, None]:
            contexts, words, _ = K.n_grams([f"{context} {word}" if word else context], 3)
            place = -2 if word else -1
            total += K.probabilities(model, [c[place:][:1] for c in contexts], words[place:][:1])[0][0]
        contexts, _, _ = K.n_grams([f"{context} unseen"], 3)
        unseen = K.n_grams(["unseen"], 3)[1][:1]
        total += K.probabilities(model, [c[-2:-1] for c in contexts], unseen)[0][0]
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_counts_beyond_two_bytes():
    n = np.array([1, 70_000, 65_535, 65_534], np.int64)
    context, word = np.array([1, 1, 2, 2], np.uint64), np.array([5, 6, 5, 7], np.uint64)
    file = K.HashFile.__new__(K.HashFile)
    data, at, file.arrays = np.frombuffer(K.longer_file(context, word, n), np.uint8), 0, []
    for kind in K.HashFile.KINDS[2]:
        count, size = int(data[at : at + 8].view("<i8")[0]), np.dtype(kind).itemsize
        file.arrays.append(data[at + 8 : at + 8 + count * size].view(kind))
        at += 8 + -(-count * size // 8) * 8
    assert file.counts(K.key_of(context, word)).tolist() == n.tolist()
    assert file.counts(K.key_of(context + np.uint64(9), word)).tolist() == [0] * 4
    total, kinds = file.contexts(np.array([1, 2, 3], np.uint64))
    assert total.tolist() == [70_001, 131_069, 0] and [k.tolist() for k in kinds] == [[1, 0, 0], [0, 0, 0], [1, 2, 0]]


def test_without_training_texts(spark, odd_docs, no_docs):
    model = K.train(no_docs)
    assert model.tokens == 0 and K.score(no_docs, model).count() == 0
    assert {r["score"] for r in K.score(odd_docs, model).collect()} == {0.0}
    with pytest.raises(ValueError):
        K.train(no_docs, order=1)


def test_the_registered_order_uses_two_words_of_context(spark):
    texts = ["a x p", "b x q"] * 20 + ["a x q", "b x p"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    scored = {texts[r["doc_id"]]: r["score"] for r in K.score(docs, K.train(docs)).collect()}
    assert scored["a x p"] > scored["a x q"] + 0.3 and scored["b x q"] > scored["b x p"] + 0.3


@pytest.mark.parametrize("most", [1, 40])
def test_rarer_words_count_like_common_ones(spark, some_docs, monkeypatch, most):
    docs = some_docs.select("doc_id", "text").limit(30).cache()
    monkeypatch.setattr(K, "COMMON_WORDS", most)
    monkeypatch.setattr(K, "HELD_TOKENS", 1_500)
    brute = Brute([r["text"] for r in docs.collect()], 3)
    rows = K.score(docs, K.train(docs, 3, bucket_bytes=20_000)).collect()
    assert np.allclose(sorted(r["score"] for r in rows), sorted(brute.score(r["text"]) for r in docs.collect()), rtol=1e-9)


def test_rows_of_counts_come_back():
    numbering = K.Numbering(np.array([7, 3], np.uint64))
    rarer, numbers = numbering.of_texts(np.array([3, 9, 7, 1 << 63, 9], np.uint64))
    assert numbering.hashes(rarer, numbers).tolist() == [3, 9, 7, 1 << 63, 9]
    columns = [np.sort(numbers), numbers]
    n = np.array([1, 2, 300, 70_000, 1 << 40], np.int64)
    back, first, second, *counts = K.unpacked(numbering.row(rarer, columns, n, n[::-1]))
    assert [numbering.hashes(back, c).tolist() for c in (first, second)] == [numbering.hashes(rarer, c).tolist() for c in columns]
    assert [c.tolist() for c in counts] == [n.tolist(), n[::-1].tolist()]


def test_counts_are_stored_only_in_the_files_of_the_model(spark, some_docs):
    def folders():
        return {p.name for p in Path(K.shared_path(spark, "any")).parent.glob("*")}

    before = folders()
    model = K.train(some_docs.select("doc_id", "text").limit(30), bucket_bytes=20_000)
    assert model.buckets > 2 and folders() - before == {Path(model.folder).name}


def test_buckets_of_words_only_pass_on_the_sums(spark):
    """More buckets than contexts: many have nothing of an order but sums of longer ones."""
    texts = ["a b a c", "b a b " + "x " * 700, "d", "x y " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    brute, model = Brute(texts, 3), K.train(docs, 3, bucket_bytes=40)
    assert model.buckets > 40 and (model.tokens, model.vocabulary) == (brute.n, brute.vocabulary)
    for row in K.score(docs, model).collect():
        assert math.isclose(row["score"], brute.score(texts[row["doc_id"]]), rel_tol=1e-9)
        assert math.isclose(row["base_score"], brute.base(texts[row["doc_id"]]), rel_tol=1e-9)


def test_a_context_takes_five_bytes_and_all_kinds_come_back():
    n = 1 + np.arange(600, dtype=np.int64)
    once = np.arange(10_000, dtype=np.uint64)
    context = np.concatenate([once, 20_000 + np.arange(600, dtype=np.uint64)])
    data = np.frombuffer(K.longer_file(context, np.ones_like(context), np.concatenate([np.ones(10_000, np.int64), n])), np.uint8)
    directories, tables = 2 * 4 * ((1 << 16) + 1), 600 * (8 + 3 * 4)
    assert len(data) <= directories + tables + len(context) * (5 + 5) + 600 * (4 + 8) * 2 + 8 * 2 * len(K.HashFile.KINDS[2])
    file, at = K.HashFile.__new__(K.HashFile), 0
    file.arrays = []
    for kind in K.HashFile.KINDS[2]:
        count, size = int(data[at : at + 8].view("<i8")[0]), np.dtype(kind).itemsize
        file.arrays.append(data[at + 8 : at + 8 + count * size].view(kind))
        at += 8 + -(-count * size // 8) * 8
    total, kinds = file.contexts(context)
    assert total.tolist() == [1] * 10_000 + n.tolist()
    assert [k[10_000:].tolist() for k in kinds] == [(n == 1).tolist(), (n == 2).tolist(), (n > 2).tolist()]
    assert file.counts(K.key_of(context, np.ones_like(context))).tolist() == total.tolist()
