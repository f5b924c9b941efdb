"""Approximate neighbours: recall against brute force, ties, and rows that take no part."""

import numpy as np
import pytest

from thermolake.llm import ann
from thermolake.llm.queries import op1_nearest

DDL = "id bigint, vector array<double>, rank string, shard string"


def brute(vectors, query, k):
    ids = np.array([i for i, _ in vectors])
    score = np.sqrt(((np.array([v for _, v in vectors]) - query[1]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, score)) if ids[i] != query[0]][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def found(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(row["query_id"], []).append((row["id"], row["score"]))
        assert len(out[row["query_id"]]) == row["rank"]
    return out


def test_query_over_the_whole_table(spark, sf_dir):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rows = op1_nearest(spark, sf_dir).withColumnRenamed("vec_id", "id").collect()
    got = found(rows)
    assert set(got) == {i for i, _ in vectors if i % 100 == 0}
    hits = 0
    for query in (v for v in vectors if v[0] % 100 == 0):
        best = dict(brute(vectors, query, 10))
        hits += len(best.keys() & dict(got[query[0]]).keys())
        exact = dict(brute(vectors, query, len(vectors)))
        assert all(abs(exact[i] - score) < 1e-12 for i, score in got[query[0]])
    assert hits >= 0.95 * 10 * len(got)


def test_recall_over_many_shards_and_blocks(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    vectors = [(i, (centres[i % 30] + 0.1 * rng.normal(size=16)).tolist()) for i in range(1_500)]
    rows = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], DDL)
    index = ann.build(rows, k=10, shard_rows=200)
    assert index.count() == 8 and {r["nodes"] for r in index.collect()} != {0}
    got = found(ann.search(index, rows.filter("id % 50 = 0"), k=10, block=7).collect())
    best = {q[0]: dict(brute(vectors, q, 10)) for q in vectors if q[0] % 50 == 0}
    assert set(got) == set(best) and all(len(n) == 10 for n in got.values())
    assert sum(len(best[q].keys() & dict(got[q]).keys()) for q in best) >= 0.9 * 10 * len(best)


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.0, 1.0]), (100, [0.0, 1.0]), (101, [-0.0, 1.0]), (102, [1.0, 1.0])]
    bad = [(200, None), (201, [0.0, 0.0]), (202, [nan, 1.0]), (203, [inf, 1.0]), (204, [None, 1.0]), (None, [1.0, 0.0]), (205, [])]
    other = [(300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 4.0])]
    frame = spark.createDataFrame([(i, v, "x", None) for i, v in rows + bad + other], DDL)
    got = found(ann.search(ann.build(frame, k=5), frame, k=5).collect())
    assert set(got) == {*range(40), 100, 101, 102, 300, 301}
    good = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows})
    for query in good:
        assert got[query[0]] == brute(good, query, 5)
    assert got[300] == [(301, 1.0)] and got[301] == [(300, 1.0)]


def test_fewer_candidates_than_asked_for(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(7)]
    frame = spark.createDataFrame([(i, v, "", "") for i, v in vectors], DDL)
    got = found(ann.search(ann.build(frame, k=10), frame, k=10).collect())
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q[0]: [i for i, _ in brute(vectors, q, 10)] for q in vectors}


def test_an_isolated_part_of_a_graph_is_still_reached():
    graph = ann.Graph(np.eye(4, dtype=np.float32), [np.arange(4)], [np.full((4, 2), -1, np.int32)], 0)
    near, _ = graph.search(np.eye(4, dtype=np.float32), ef=4)
    assert np.sort(near, 1).tolist() == [[0, 1, 2, 3]] * 4


@pytest.mark.parametrize("rows", [[], [(1, None, "", "")]])
def test_empty_tables(spark, rows):
    frame = spark.createDataFrame(rows, DDL)
    index = ann.build(frame, k=3)
    assert index.count() == 0 and ann.search(index, frame, k=3).count() == 0


def test_of_an_id_with_several_vectors_the_least_is_asked(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)]
    asked = [(100, [20.2, 1.0]), (100, [3.1, 1.0]), (100, [9.0, 1.0])]
    frame = lambda r: spark.createDataFrame([(i, v, "x", "y") for i, v in r], DDL)
    for order in (asked, asked[::-1]):
        got = found(ann.search(ann.build(frame(rows), k=3), frame(order), k=3).collect())
        assert [i for i, _ in got[100]] == [3, 4, 2]
