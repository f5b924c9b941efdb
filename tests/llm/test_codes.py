"""Vector codes against all distances, in Python's integers; what the tree leaves out; odd vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from thermolake.llm import codes
from thermolake.llm.queries import op13_vector_codes

DDL = "id bigint, vector array<float>, label int, code string, error string, of_label string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], DDL)


def brute(rows, parts=8, entries=16, rounds=6):
    rows = [(k, [math.floor(4096 * x) for x in v], l) for k, v, l in rows if v and None not in v and all(math.isfinite(x) for x in v)]
    rows = [r for r in rows if len(r[1]) % parts == 0]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(order[0][1])] if rows else []
    order = [r for r in order if len(r[1]) == len(order[0][1])]
    width = len(order[0][1]) // parts if rows else 0
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(r[1])[p] for r in order[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in rows:
                held.setdefault(near(p, cut(v)[p])[1], []).append(cut(v)[p])
            books[p] = [[sum(c) // len(c) for c in zip(*held[i])] if i in held else e for i, e in enumerate(books[p])]
    out, labels = [], {}
    for k, v, l in rows:
        found = [near(p, x) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        labels[l] = labels.get(l, 0) + error
        out.append((k, "".join(f"{i:02x}" for _, i in found), error, l))
    text = ",".join(str(c) for book in books for e in book for c in e)
    return sorted(((k, c, e, labels[l], hashlib.sha256(text.encode()).hexdigest()) for k, c, e, l in out), key=str)


def coded(frame, **options):
    found = codes.compress(frame, **options).select("id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(map(tuple, found.collect()), key=str)


def vectors(n, length, seed, spread=1.0):
    rng = random.Random(seed)
    return [(rng.choice([i, i // 2, -i]), [float(np.float32(rng.gauss(0, spread))) for _ in range(length)], rng.choice([None, 1, 2, 2])) for i in range(n)]


@pytest.mark.parametrize("n,length,seed,spread", [(90, 16, 1, 1), (40, 8, 2, 0.0005), (9, 24, 3, 1), (1, 8, 4, 1), (60, 16, 5, 1e7), (30, 8, 6, 200_000.0)])
def test_equals_all_distances(spark, n, length, seed, spread):
    rows = vectors(n, length, seed, spread)
    rows = rows if spread < 1e6 else [(k, [x if abs(x) < 3e4 else float(np.float32(x / 1e3)) for x in v], l) for k, v, l in rows]
    assert coded(rows_of(spark, rows)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(30, 16, 7)
    rows += [(-99, None, 1), (-98, [None] * 16, 1), (-97, [nan] * 16, 1), (-96, [inf] + [0.0] * 15, 1), (-95, [], None), (-94, [1.0] * 15, 2)]
    rows += [(500, [1.0] * 8, 1), (None, [0.5] * 16, None), (501, [0.0] * 16, 3), (501, [0.0] * 16, 3), (501, [1.0] * 16, 3)] + rows[:5]
    assert coded(rows_of(spark, rows)) == brute(rows)


def test_equal_vectors_take_the_first_entry(spark):
    rows = [(i, [0.25] * 16, None) for i in range(40)]
    found = coded(rows_of(spark, rows))
    assert found == brute(rows) and {r[1] for r in found} == {"00" * 8}


def test_an_empty_table(spark):
    assert coded(rows_of(spark, [])) == []
    assert coded(rows_of(spark, [(1, None, 1)])) == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, op13_vector_codes(spark, sf_dir).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("size,span,seed", [(16, 4, 0), (16, 1000, 1), (200, 3, 2), (64, 10**6, 3), (5, 2, 4), (1, 9, 5), (16, 10**12, 6)])
def test_tree_equals_a_full_search_with_ties(size, span, seed):
    rng = np.random.default_rng(seed)
    kind = object if span > 1 << 27 else np.int64
    entries = rng.integers(-span, span, (size, 3)).astype(kind)
    rows = np.concatenate([rng.integers(-span, span, (400, 3)).astype(kind), entries])
    index, square = codes.Gnat(entries).nearest(rows)
    for row, i, d in zip(rows, index, square):
        assert (d, i) == min((sum((int(a) - int(b)) ** 2 for a, b in zip(row, e)), j) for j, e in enumerate(entries))


def test_subtrees_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-(10**6), 10**6, (20, 4))
    entries = np.concatenate([c + rng.integers(-50, 50, (10, 4)) for c in centres])
    tree = codes.Gnat(entries)
    rows = np.concatenate([c + rng.integers(-50, 50, (30, 4)) for c in centres])
    tree.nearest(rows)
    assert tree.measured < 0.4 * len(rows) * len(entries)
