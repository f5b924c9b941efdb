"""The join against all pairs, and the pieces of its argument."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermolake.llm import jaccard as J
from thermolake.llm.components import components
from thermolake.llm.queries import op5_jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a, b):
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


def brute(rows):
    """{id: (size, component)} of (id, text) rows, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for place, (_, s) in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(place)
    for place, (i, s) in enumerate(sets):
        for other in {p for shingle in s for p in holders[shingle] if p < place}:
            j, t = sets[other]
            if linked(s, t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def near_copies(seed, groups=25):
    """Groups of edited copies around the similarity of 80 %, of sizes from one word on."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = []
    for _ in range(groups):
        text = [word() for _ in range(rng.choice([1, 4, 5, 6, 8, 9, 10, 13, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(text)
            for _ in range(rng.randint(0, 1 + len(text) // 25)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
                copy = copy or [word()]
            rows.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in copy))
            if rng.random() < 0.3:
                text = copy  # chains
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 300), st.integers(0, 400), st.integers(0, 1 << 30))
def test_linked_sets_share_a_cell(size, edits, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
    drop = min(edits % (size // 4 + 1), len(a) - 1)
    fresh = rng.integers(0, 1 << 64, edits % 7 * (size // 25), np.uint64)
    b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), drop, replace=False)), fresh]))
    overlap = len(np.intersect1d(a, b))
    if 100 * overlap >= 80 * (len(a) + len(b) - overlap) and not np.array_equal(a, b):
        assert np.intersect1d(J.cells(a), J.cells(b)).size


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 80), st.integers(0, 1 << 30))
def test_the_tree_keeps_every_pair_that_its_bound_allows(n, seed):
    rng = np.random.default_rng(seed)
    counts = rng.poisson(rng.choice([0.5, 3]), (n, 8)).astype(np.uint16)
    counts[n // 2 :] = counts[: n - n // 2] + rng.integers(0, 2, (n - n // 2, 8))
    sizes = counts.sum(1).astype(np.int64)
    found = {pair for i, j in J.tree_pairs(counts, sizes) for pair in zip(i.tolist(), j.tolist())}
    expected = {(i, j) for i in range(n) for j in range(i + 1, n) if 9 * np.minimum(counts[i], counts[j]).sum() >= 4 * (sizes[i] + sizes[j])}
    assert found == expected


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_all_pairs(spark, seed):
    rows = near_copies(seed)
    found = J.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_groups_larger_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE_SETS", 8)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(80)]
    rows = []
    for i in range(60):  # a chain: neighbours link, distant ones do not
        base[i % 80] = f"x{i}"
        rows.append((i, " ".join(base)))
    found = J.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_query_over_the_whole_table(spark, sf_dir, some_docs):
    rows = [(r["doc_id"], r["text"]) for r in some_docs.collect()]
    assert sorted(map(tuple, op5_jaccard(spark, sf_dir).collect())) == brute(rows)


def test_odd_rows(odd_docs):
    found = sorted((tuple(r) for r in J.classes(odd_docs).collect()), key=str)
    sizes = [(r["doc_id"], len(shingles(r["text"]))) for r in odd_docs.collect()]
    assert sorted([f[:2] for f in found], key=str) == sorted(sizes, key=str)
    assert {f[2] for f in found if f[0] in (1, 2)} == {1} and all(f[2] == f[0] for f in found if f[0] != 2)
    kept = J.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 7, 9, None, None]))


def test_rows_that_share_an_id_are_one_document(spark):
    texts = ["a b c d e f g", "p q r s t u v"]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[1])]
    found = J.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["component_id"] for r in found} == {1} and len(found) == 4


def test_an_empty_table(no_docs):
    assert J.classes(no_docs).count() == 0 and J.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in touched)
