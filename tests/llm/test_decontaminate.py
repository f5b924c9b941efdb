"""Spaced seeds: nothing tolerated is lost; equal to comparing every window."""

import random
import re
from itertools import combinations

import pytest

from thermolake.llm import decontaminate as D
from thermolake.llm.queries import op3_decontaminate

WORD = re.compile(r"[^\W_]+")


def split(text):
    return WORD.findall((text or "").lower())


def brute(text, item):
    """Largest overlap over all diagonals: (equal words, -start, words)."""
    doc, words = split(text), split(item)
    window = min(D.WINDOW, len(words))
    need = D.EQUAL if window == D.WINDOW else window
    best = None
    if len(words) >= D.LEAST:
        for diagonal in range(-len(words), len(doc)):
            same = {i: words[i] == doc[i + diagonal] for i in range(len(words)) if 0 <= i + diagonal < len(doc)}
            good = [i for i in same if i + window - 1 in same and sum(same[i + k] for k in range(window)) >= need]
            if good:
                first, last = good[0], good[-1] + window
                overlap = (sum(same[i] for i in range(first, last)), -(first + diagonal), last - first)
                best = max(best or overlap, overlap)
    return best


def test_masks_find_every_tolerated_substitution():
    for places in combinations(range(D.WINDOW), D.WINDOW - D.EQUAL):
        assert any(not {at + m for m in mask} & set(places) for mask in D.MASKS for at in range(D.WINDOW - mask[-1]))


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6 if seed % 2 else 60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 4, 5, 7, 12, 13, 14, 30])))) for i in range(12)]
    docs = []
    for i in range(40):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            copied = split(rng.choice(items)[1])
            a = rng.randint(0, len(copied))
            copied = [w if rng.random() < 0.85 else "other" for w in copied[a // 3 :]]
            at = rng.randint(0, len(words))
            words[at:at] = copied
        docs.append((i, "  ".join(w.upper() if rng.random() < 0.2 else w + rng.choice([",", ".", ""]) for w in words)))
    return items, docs


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_comparing_every_window(seed):
    items, docs = random_case(seed)
    block = D.Block.of(items)
    found = block.hits([text for _, text in docs])
    for (_, text), hits in zip(docs, found):
        expected = {i: best for i, item in items if (best := brute(text, item))}
        assert {h["item_id"]: (h["equal"], -h["start"], h["end"] - h["start"]) for h in hits} == expected


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    items, docs = random_case(3)
    bench = spark.createDataFrame(items + items[:2] + [(None, "x"), (99, None)], "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    one = D.overlaps(frame, bench).collect()
    monkeypatch.setattr(D, "BLOCK_BYTES", 100)
    assert len(list(D.blocks(bench))) > 2
    key = lambda r: (r["doc_id"], r["item_id"])
    assert one and sorted(D.overlaps(frame, bench).collect(), key=key) == sorted(one, key=key)
    dirty = {r["doc_id"] for r in one}
    assert {r["doc_id"] for r in D.clean(frame, bench).collect()} == {i for i, _ in docs} - dirty


def test_query_over_the_whole_table(spark, sf_dir, some_docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = {(r["doc_id"], r["item_id"]): (r["equal"], -r["start"], r["end"] - r["start"]) for r in op3_decontaminate(spark, sf_dir).collect()}
    assert found
    for doc in some_docs.filter("length(text) < 1500").collect():
        words = set(split(doc["text"]))
        for item, text in items:
            likely = sum(w in words for w in split(text)) >= 10
            assert found.get((doc["doc_id"], item)) == (brute(doc["text"], text) if likely else None)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog")], "item_id bigint, text string")
    clean = D.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r["doc_id"]) for r in odd_docs.collect() if r["doc_id"] not in (1, 2))
    none = spark.createDataFrame([], bench.schema)
    assert D.clean(odd_docs, none).count() == odd_docs.count() and D.overlaps(no_docs, bench).count() == 0
