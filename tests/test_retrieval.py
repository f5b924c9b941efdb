"""Chunking, BM25, dense search, fusion and answers against plain-Python references."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as hyp
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from thermolake.operators import answers as A
from thermolake.operators import block_topk as K
from thermolake.operators import bm25 as B
from thermolake.operators import corpus as D
from thermolake.operators import dense as V
from thermolake.operators import fusion as X
from thermolake.operators import postings as P
from thermolake.operators import quality  # noqa: F401
from thermolake.operators import term_scan as T
from thermolake.session import checkpoint_dir

from tests.test_quality import HEALTHY, gold


def corpus(spark, texts, source="s"):
    rows = [(str(i), f"{source}{i}", t, f"{i:020d}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id string, source string, text string, ord_key string")


def plain_chunks(texts, n=2):
    """Windows of n sentences, each starting n - 1 after the last, until one covers the end."""
    out = []
    for d, text in enumerate(texts):
        parts = re.split(r"(?<=[.!?])\s+", text.strip())
        start, step = 0, max(1, n - 1)
        while True:
            body = " ".join(parts[start : start + n]).strip()
            if body:
                out.append((f"{d}#c{start:02d}", body))
            if start + n >= len(parts):
                break
            start += step
    return out


def spark_chunks(spark, texts, n=2):
    rows = D.chunk(corpus(spark, texts), n).orderBy("ord_key", "pos").collect()
    return [(r.id, r.text) for r in rows]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_chunks_match_plain_python(spark, n):
    rnd = random.Random(n)
    texts = ["", "   ", "one", "A rate of 0.25. b! c? d", "x.y.z", "a. b.\x1cc.  ", ". . ."]
    pieces = ["a", "bé", ".", "!", "? ", " ", "\n", " ", "\x1f", "c.d ", "。"]
    texts += ["".join(rnd.choices(pieces, k=rnd.randrange(40))) for _ in range(60)]
    texts.append(" ".join(f"s{i}." for i in range(130)))
    assert spark_chunks(spark, texts, n) == plain_chunks(texts, n)


def test_two_sentence_chunk_count_of_the_fixture_corpus(spark):
    counts = [5, 3, 4, 3, 3, 3, 3, 3, 3, 3]
    static = corpus(spark, [" ".join(f"Word{i} is here." for i in range(c)) for c in counts])
    kpis = D.kpi_documents(gold(spark, HEALTHY + [("X", *HEALTHY[0][1:])]))
    assert D.chunk(D.union_corpora(static, kpis)).count() == 29


def test_kpi_document_text_and_order(spark):
    docs = D.kpi_documents(gold(spark, HEALTHY)).orderBy("ord_key").collect()
    assert docs[0].id == "gold_CNC_MILL_01_2024-03-01"
    assert docs[0].source.endswith("/machine_daily_kpi/CNC_MILL_01/2024-03-01")
    assert docs[0].text == (
        "On 2024-03-01, machine CNC_MILL_01 reported 4 temperature readings. 1 of them were anomalies, "
        "an anomaly rate of 0.25. The average temperature was 75.0 degrees Celsius, ranging from 66.0 "
        "to 96.5, a thermal spread of 30.5 degrees."
    )


WORDS = "the a pump valve heats cold über Straße rotor x1 the the a".split()


def index_of(spark, texts, path, **kwargs):
    return B.TextIndex.build(D.chunk(corpus(spark, texts), 1), path, **kwargs)


def okapi(chunks, query, k):
    docs = [t.lower().split() for _, t in chunks]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = {}
    for d in docs:
        for w in set(d):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: v if v >= 0 else floor for w, v in idf.items()}
    scores = []
    for d in docs:
        s = 0.0
        for w in query.lower().split():
            tf = d.count(w)
            s += idf.get(w, 0.0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / mean))
        scores.append(round(s, 9))
    best = sorted(range(n), key=lambda i: -scores[i])[:k]
    return [(chunks[i][0], scores[i]) for i in best]


@pytest.mark.parametrize("limit", [1 << 20, 200])
def test_bm25_matches_plain_okapi(spark, tmp_path, monkeypatch, limit):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randrange(1, 9))) for _ in range(120)]
    texts += texts[:30]  # exact copies tie, and keep corpus order
    index = index_of(spark, texts, f"{tmp_path}/i")
    queries = ["pump", "the the valve", "nothing matches", "über STRASSE rotor x1 cold", "a"] + texts[:20]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, query string")
    blocks = []
    split = K.query_blocks
    monkeypatch.setattr(K, "KEPT_BYTES_PER_HIT", 0)

    def small_blocks(q, size, k):
        for block in split(q, size, k, limit):
            blocks.append(block)
            yield block

    monkeypatch.setattr(B, "query_blocks", small_blocks)
    found = B.bm25_search(index, asked, k=8).collect()
    assert (len(blocks) > 1) == (limit == 200)
    chunks = plain_chunks(texts, 1)
    for q, text in enumerate(queries):
        got = sorted((r.rank, r.id, r.score) for r in found if r.query_id == q)
        want = [(i + 1, c, s) for i, (c, s) in enumerate(okapi(chunks, text, 8))]
        assert [g[:2] for g in got] == [w[:2] for w in want], text
        assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-8)


def test_postings_and_frequencies(spark, tmp_path):
    index = index_of(spark, ["b a b", "a", "c b b b"], f"{tmp_path}/i")
    got = {(r.term, r.id): (r.tf, r.dl) for r in index.postings().collect()}
    assert got == {
        ("b", "0#c00"): (2, 3), ("a", "0#c00"): (1, 3), ("a", "1#c00"): (1, 1),
        ("c", "2#c00"): (1, 4), ("b", "2#c00"): (3, 4),
    }
    assert {r.term: r.df for r in index.terms().collect()} == {"a": 2, "b": 2, "c": 1}


def vector_rows(spark, matrix):
    rows = [(str(i), f"{i:020d}", 0, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id string, ord_key string, pos int, embedding array<double>")


def test_dense_search_is_exact_with_ties_in_order(spark, monkeypatch):
    rng = np.random.default_rng(1)
    m = np.round(rng.normal(size=(150, 6)), 1)
    m = np.vstack([m, m[:40]])
    rows = vector_rows(spark, m).repartition(5)
    asked = rows.select(F.col("id").cast("bigint").alias("query_id"), "embedding")
    want = {}
    for q in range(len(m)):
        d = np.round(((m - m[q]) ** 2).sum(axis=1), 9)
        want[q] = [str(i) for i in sorted(range(len(m)), key=lambda i: (d[i], i))[:5]]
    split = K.query_blocks
    monkeypatch.setattr(K, "KEPT_BYTES_PER_HIT", 0)
    for limit in (1 << 20, 3000):
        monkeypatch.setattr(V, "query_blocks", lambda q, size, k, limit=limit: split(q, size, k, limit))
        got = {}
        for r in sorted(V.dense_search(rows, asked, k=5).collect(), key=lambda r: r.rank):
            got.setdefault(r.query_id, []).append(r.id)
        assert got == want


def test_no_queries_give_no_hits(spark, tmp_path):
    rows = vector_rows(spark, [[1.0, 0.0]])
    none = spark.createDataFrame([], "query_id bigint, query string, embedding array<double>")
    assert V.dense_hits(V.dense_search(rows, none)).isEmpty()
    index = index_of(spark, ["a b"], f"{tmp_path}/i")
    assert B.bm25_hits(B.bm25_search(index, none)).isEmpty()


def test_probed_search_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 10)) * 5
    m = np.vstack([c + rng.normal(size=(60, 10)) for c in centres])
    rows = vector_rows(spark, m)
    asked = rows.select(F.col("id").cast("bigint").alias("query_id"), "embedding")
    exact = V.dense_search(rows, asked, k=5)
    model = V.fit_clusters(rows, 8)
    clustered = V.assign_clusters(rows, model)
    near = V.probed_search(clustered, model, asked, probes=2, k=5)
    assert V.recall(exact, near).first().recall > 0.95
    every = V.probed_search(clustered, model, asked, probes=8, k=5)
    assert V.recall(exact, every).first().recall == 1.0
    work = V.distances_computed(clustered, model, asked, probes=2).first()
    assert work.exact == len(m) ** 2 and 0 < work.probed < 0.5 * work.exact
    assert V.distances_computed(clustered, model, asked, probes=8).first().probed == len(m) ** 2


def test_vectors_without_a_distance_are_refused(spark):
    good = vector_rows(spark, [[1.0, 0.0], [0.0, 1.0]])
    asked = good.select(F.col("id").cast("bigint").alias("query_id"), "embedding")
    for bad in (None, [1.0], [1.0, None]):
        row = spark.createDataFrame([("9", "9", 0, bad)], good.schema)
        with pytest.raises(PySparkException, match="embedding is null"):
            V.dense_search(good.unionByName(row), asked)
    with pytest.raises(PySparkException, match="text is null"):
        V.hashing_embedder()(spark.createDataFrame([(None,)], "text string")).collect()


def test_matches_only_are_sent(spark, tmp_path, monkeypatch):
    texts = [f"word{i} common" for i in range(40)]
    index = index_of(spark, texts, f"{tmp_path}/i")
    asked = spark.createDataFrame([(i, "nothing here" if i % 2 else f"word{i}") for i in range(20)], "query_id bigint, query string")
    sent, pad = [], B.pad
    monkeypatch.setattr(B, "pad", lambda found, *rest: sent.append(found.count()) or pad(found, *rest))
    found = B.bm25_search(index, asked, k=8).collect()
    assert sent == [10]  # one match per matching query, nothing for the others
    assert len(found) == 20 * 8
    assert [r.id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 1] == [f"{i}#c00" for i in range(8)]


def test_blocks_of_queries_are_released(spark, monkeypatch):
    live, most = [], []
    broadcast = spark.sparkContext.broadcast

    def counted(value):
        shared = broadcast(value)
        live.append(shared)
        most.append(len(live))
        destroy = shared.destroy
        monkeypatch.setattr(shared, "destroy", lambda: (live.remove(shared), destroy()))
        return shared

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    monkeypatch.setattr(K, "KEPT_BYTES_PER_HIT", 1 << 20)
    split = K.query_blocks
    monkeypatch.setattr(V, "query_blocks", lambda q, size, k: split(q, size, k, 32 << 20))
    rows = vector_rows(spark, [[float(i), 0.0] for i in range(20)])
    V.dense_search(rows, rows.select(F.col("id").cast("bigint").alias("query_id"), "embedding"), k=8).collect()
    assert len(most) > 1 and max(most) == 1 and not live


def random_texts(seed, n, words=400, length=30):
    """Words of very different frequencies; some texts repeat."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    texts = [" ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(1, length))) for _ in range(n)]
    return texts + texts[: n // 10]


def hits_by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.id, round(r.score, 7)))
    return out


def scanned(index, asked, k):
    """All chunks scored from their tokens."""
    blocks = K.query_blocks(asked, F.lit(64), k)
    found = B._scan(index, blocks, k, 1.5, 0.75).filter("score > 0")
    return hits_by_query(K.rank_hits(B.pad(found, asked, index.chunks(), k), k))


@pytest.mark.parametrize("bits,tokens,together", [(14, 2_000_000, 128), (4, 40, 3)])
def test_pruned_search_equals_a_scan_of_all_chunks(spark, tmp_path, monkeypatch, bits, tokens, together):
    for name, value in (("SHARD_BITS", bits), ("GATHERED_TOKENS", tokens), ("QUERIES_TOGETHER", together), ("POSTINGS_TOGETHER", tokens)):
        monkeypatch.setattr(P, name, value)
    texts = random_texts(3, 500)
    index = index_of(spark, texts, f"{tmp_path}/i")
    queries = [*texts[:25], "w0", "w0 w1 w2", "w399 w0", "none", "w5 w5 w5 w300"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, query string")
    for k in (1, 8, 60):
        assert hits_by_query(B.bm25_search(index, asked, k=k)) == scanned(index, asked, k)
    work = B.search_work(index, spark.createDataFrame([(0, "w0 w1 w2 w3 w300 w310")], "query_id bigint, query string"), k=1).first()
    assert work.read_blocks < work.stored_blocks and work.scored < work.of_terms


@pytest.mark.parametrize("group,tile,share", [(512, 1024, 0.0035), (7, 16, 0.2)])
def test_many_queries_are_searched_by_a_scan_with_the_same_hits(spark, tmp_path, monkeypatch, group, tile, share):
    for name, value in (("GROUP", group), ("TILE", tile), ("COLUMN_SHARE", share)):
        monkeypatch.setattr(T, name, value)
    texts = random_texts(8, 400)
    index = index_of(spark, texts, f"{tmp_path}/i")
    queries = [*texts[:40], "w0", "w0 w1 w2", "w399 w0", "none", "", "w5 w5 w5 w300"]
    asked = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(queries)], "query_id string, query string")
    monkeypatch.setattr(B, "MANY_QUERIES", len(queries))
    monkeypatch.setattr(B, "postings_searches", lambda *a: pytest.fail("postings are read"))
    for k in (1, 60):
        assert hits_by_query(B.bm25_search(index, asked, k=k)) == scanned(index, asked, k)


def test_few_pairs_are_scored_twice():
    """Rough scores leave out most pairs, also where floors have to come from the rows themselves."""
    texts = [t.split() for t in random_texts(4, 6000, words=3000)]
    df = {}
    for words in texts:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    entries = [(q, w, math.log(len(texts) / df[w]) + 0.1, df[w]) for q, words in enumerate(texts[:50]) for w in sorted(set(words))]
    rows = pa.table(list(zip(*entries, strict=True)), names=["query_id", "term", "weight", "df"])
    ids, asked = T.AskedGroups.of(list(range(50)), rows, len(texts))
    scorer, again = T.TermScorer(asked, 50, 15.0, 1.5, 0.75, 8), []
    exact = scorer._exact
    scorer._exact = lambda group, at, *rest: again.append(len(at)) or exact(group, at, *rest)
    best = {q: [] for q in ids}
    for low in range(0, len(texts), 1000):
        batch = pa.RecordBatch.from_arrays([pa.array(texts[low : low + 1000])], ["tokens"])
        for start, (_, query, score) in scorer(batch, np.full(50, -np.inf)):
            for q, s in zip(query + start, score, strict=True):
                best[ids[q]].append(s)
    assert sum(again) < 0.05 * 50 * len(texts)
    for q, words in enumerate(texts[:50]):
        wanted = {w: weight for i, w, weight, _ in entries if i == q}
        scores = [sum(wanted[w] * (c := t.count(w)) * 2.5 / (c + 1.5 * (0.25 + 0.75 * len(t) / 15.0)) for w in set(t) if w in wanted) for t in texts]
        assert np.allclose(sorted(best[q])[-8:], sorted(scores)[-8:])


def test_chunks_stay_where_they_lie_and_ties_follow_the_corpus(spark, tmp_path):
    """Neither chunks nor postings are put in order to be written, tokens are not stored, and of equal texts
    the first ones of the corpus are found, wherever they lie."""
    texts = dict(enumerate(["same words here"] * 40 + [f"w{i} other" for i in range(80)]))
    rows = keyed(spark, dict(reversed(texts.items()))).coalesce(1)
    index = B.TextIndex.build(D.chunk(rows, 1), f"{tmp_path}/i")
    stored = spark.read.parquet(f"{tmp_path}/i/chunks/segment=0")
    assert "tokens" not in stored.columns and "tokens" in index.chunks().columns
    lying = [r.doc_id for r in stored.orderBy("no").collect()]
    assert lying == [str(d) for d in reversed(range(120))]
    asked = spark.createDataFrame([(0, "same words")], "query_id bigint, query string")
    found = B.bm25_search(index, asked, k=5).orderBy("rank").collect()
    assert [r.id for r in found] == [f"{d}#c00" for d in range(5)]


def test_blocks_hold_all_postings_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "SHARD_BITS", 3)
    monkeypatch.setattr(P, "GATHERED_TOKENS", 25)
    texts = random_texts(4, 60)
    index = index_of(spark, texts, f"{tmp_path}/i")
    want = {}
    for i, text in plain_chunks(texts, 1):
        words = text.lower().split()
        want.update({(w, i): (words.count(w), len(words)) for w in words})
    rows = index.postings().collect()
    assert {(r.term, r.id): (r.tf, r.dl) for r in rows} == want and len(rows) == len(want)
    for r in index.blocks().collect():
        assert r.n == len(r.places) == len(r.tfs) == len(r.dls) <= 8
        assert (r.max_tf, r.min_dl) == (max(r.tfs), min(r.dls)) and r.places == sorted(set(r.places))


def test_term_filters_reach_the_scan(spark, tmp_path):
    index = index_of(spark, random_texts(5, 100), f"{tmp_path}/i")
    asked = spark.createDataFrame([(0, "w7 w90")], "query_id bigint, query string")
    search = next(B.postings_searches(index, K.query_blocks(asked, F.lit(64), 8), 8, 1.5, 0.75))
    found = search.read(np.ones(len(search.asked.query), dtype=bool))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert re.search(r"PartitionFilters: \[.*bucket", scan) and re.search(r"PushedFilters: \[.*In\(term, \[w7,w90\]\)", scan)
    assert {r.term for r in found.collect()} == {"w7", "w90"}
    files = {r[0] for r in index.blocks().select(F.input_file_name()).distinct().collect()}
    assert len({r[0] for r in found.select(F.input_file_name()).collect()} - {""}) < len(files)


def test_index_after_changes_equals_a_rebuilt_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "SHARD_BITS", 5)
    texts = dict(enumerate(random_texts(6, 150)))
    chunks_of = lambda t: D.chunk(keyed(spark, t), 1)
    index = B.TextIndex.build(chunks_of(texts), f"{tmp_path}/i")
    stamps = lambda s: {p: p.stat().st_mtime_ns for part in ("chunks", "postings", "terms", "removed") for p in (tmp_path / "i" / part / f"segment={s}").rglob("*.parquet")}
    seen = []
    rnd = random.Random(8)
    for step in range(3):
        seen.append((step, stamps(step)))
        gone = rnd.sample(sorted(texts), 12)
        changed = {d: f"{texts[d]} w{step} new{step} w{step}" for d in rnd.sample(sorted(set(texts) - set(gone)), 15)}
        changed |= {1000 * (step + 1) + i: f"w1 w{20 + i} new{step}" for i in range(5)}
        for d in gone:
            del texts[d]
        texts |= changed
        removed = spark.createDataFrame([(str(d),) for d in gone], "doc_id string")
        index = index.update(chunks_of(changed), removed)
        rebuilt = B.TextIndex.build(chunks_of(texts), f"{tmp_path}/again{step}")
        assert index.stats.n_chunks == rebuilt.stats.n_chunks and index.stats.total_length == rebuilt.stats.total_length
        assert abs(index.stats.mean_idf - rebuilt.stats.mean_idf) < 1e-9
        rows = lambda frame: sorted(map(tuple, frame.collect()))
        assert rows(index.terms().select("term", "df")) == rows(rebuilt.terms().select("term", "df"))
        assert rows(index.postings()) == rows(rebuilt.postings())
        asked = spark.createDataFrame(list(enumerate([*list(texts.values())[:12], f"new{step} w0", "new0 w1", "zzz"])), "query_id bigint, query string")
        assert hits_by_query(B.bm25_search(index, asked)) == hits_by_query(B.bm25_search(rebuilt, asked)) == scanned(index, asked, 8)
    for step, before in seen:
        assert before and stamps(step) == before  # no file of an earlier segment was touched
    last = index.update(chunks_of({}).limit(0), spark.createDataFrame([("nothing",)], "doc_id string"))
    assert last.stats == index.stats and rows(last.terms()) == rows(index.terms())


def keyed(spark, texts):
    rows = [(str(d), "s", t, f"{d:020d}") for d, t in texts.items()]
    return spark.createDataFrame(rows, "id string, source string, text string, ord_key string")


def test_text_vectors_are_unit_length_and_repeatable(spark):
    df = spark.createDataFrame([("a b a",), ("a b a",), ("",), ("Zürich ist schön",)], "text string")
    v = [np.array(r[0]) for r in V.hashing_embedder(32)(df).select("embedding").collect()]
    assert (v[0] == v[1]).all() and not v[2].any()
    assert np.allclose([np.linalg.norm(x) for x in (v[0], v[3])], 1)


def fuse(dense, keyword, k=60, limit=8):
    """The formula, candidate by candidate; ties by dense rank, then by keyword rank."""
    place = [{c: r for r, c in enumerate(ids, 1)} for ids in (dense, keyword)]
    table = []
    for c in set(dense) | set(keyword):
        ranks = [p.get(c, math.inf) for p in place]
        labels = [f"{n}@{r}" for n, r in zip(("dense", "bm25"), ranks, strict=True) if r < math.inf]
        table.append((-sum(1 / (k + r) for r in ranks), ranks, c, labels))
    return [(c, round(-s, 6), labels) for s, _, c, labels in sorted(table)[:limit]]


@hyp(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.permutations(range(9)), st.permutations(range(4, 13)), st.integers(0, 9)), min_size=1, max_size=5))
def test_fusion_matches_the_formula(spark, cases):
    dense, keyword = [], []
    for q, (d, b, n) in enumerate(cases):
        dense += [(q, r, f"c{c}") for r, c in enumerate(d[:n], 1)]
        keyword += [(q, r, f"c{c}") for r, c in enumerate(b, 1)]
    ddl = "query_id int, rank int, chunk_id string"
    got = X.reciprocal_rank_fusion(spark.createDataFrame(dense, ddl), spark.createDataFrame(keyword, ddl))
    rows = got.orderBy("query_id", "rank").collect()
    for q, (d, b, n) in enumerate(cases):
        mine = [(r.chunk_id, r.rrf_score, r.retrieved_by) for r in rows if r.query_id == q]
        assert mine == fuse([f"c{c}" for c in d[:n]], [f"c{c}" for c in b])


def test_rerank_keeps_input_order_on_ties_and_takes_any_scorer(spark):
    pairs = spark.createDataFrame(
        [(1, "a", "q", "xx", 1), (1, "b", "q", "yy", 2), (1, "c", "q", "zzz", 3), (2, "d", "q", "", 1)],
        "query_id int, cand_id string, query string, text string, rank int",
    )
    best = X.rerank(pairs, X.column_scorer(lambda q, t: F.length(t).cast("double")), 2).orderBy("query_id", "rank")
    assert [(r.query_id, r.rank, r.cand_id) for r in best.collect()] == [(1, 1, "c"), (1, 2, "a"), (2, 1, "d")]


TEXTS = [
    "Malformed records go to the dead letter topic. The lakehouse never sees them.",
    "The merge updates a reading in place. A corrected value replaces the old one!",
    "A failed gate stops the publish. Nothing downstream runs after a failed gate.",
    "Nothing here is relevant",
]
QUESTIONS = ["Where do malformed records go?", "What happens after a failed gate?", "zzz"]


def retrieve(spark, tmp_path):
    checkpoint_dir(spark)
    embed = V.hashing_embedder(64)
    index = B.TextIndex.build(D.chunk(corpus(spark, TEXTS)), f"{tmp_path}/i", embed=embed)
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id bigint, query string")
    vectors = V.hashing_embedder(64, "query")(asked).select("query_id", "embedding")
    scorer = X.idf_overlap(asked, index.terms())
    stages = X.funnel(
        V.dense_hits(V.dense_search(index.chunks(), vectors)),
        B.bm25_hits(B.bm25_search(index, asked)),
        asked, index.chunks(), scorer,
    )
    return asked, stages, scorer


def test_funnel_and_grounded_answers(spark, tmp_path):
    asked, stages, scorer = retrieve(spark, tmp_path)
    index = B.TextIndex(spark, f"{tmp_path}/i")
    table = X.summarise_funnel(stages, index.chunks())
    assert table.columns == X.FUNNEL_COLUMNS
    assert table.filter("source IS NULL OR source <> concat('s', substring_index(chunk_id, '#', 1))").isEmpty()
    counts = {r.stage: r["count"] for r in table.groupBy("stage").count().collect()}
    assert counts == {"dense": 12, "bm25": 12, "fused": 12, "reranked": 12}
    top = {r.query_id: r.chunk_id for r in table.filter("stage = 'reranked' AND rank = 1").collect()}
    assert top[0] == "0#c00" and top[1] == "2#c00"
    found = A.extractive_answers(stages["reranked"], asked, scorer)
    rows = {r.query_id: r for r in found.collect()}
    assert rows[0].answer.startswith("Malformed records go to the dead letter topic [Source 1].")
    assert rows[0].grounded and rows[0].citations[0].chunk_id == "0#c00"
    assert len(rows[0].all_context_citations) == 4 and len(rows[0].context_chunk_ids) == 4
    assert rows[0].context_block.startswith("[Source 1] Malformed")
    assert A.citation_audit(found, stages["reranked"]).isEmpty()
    A.require_grounded(found, stages["reranked"])
    forged = found.withColumn("citations", F.expr("transform(citations, c -> struct(c.marker, 'no such' AS chunk_id, c.doc_id, c.source))"))
    with pytest.raises(A.UngroundedAnswer):
        A.require_grounded(forged, stages["reranked"])


def test_answer_composition(spark):
    asked = spark.createDataFrame([(1, "q"), (2, "none")], "query_id int, query string")
    ddl = "query_id int, rank int, chunk_id string, text string, source string, doc_id string, query string"
    hits = [
        (1, 1, "c1", "One, two. Says [Source 9] so!", "s", "d", "q"),
        (1, 2, "c2", "ONE  two! Three? Four.", "s", "d", "q"),
    ]
    order = X.column_scorer(lambda q, t: -F.length(t).cast("double"))
    rows = A.extractive_answers(spark.createDataFrame(hits, ddl), asked, order).orderBy("query_id").collect()
    # The second chunk's repetition of "One, two." is dropped; [Source 9] is out of range.
    assert rows[0].answer == "Four [Source 2]. Three? [Source 2] One, two [Source 1]."
    assert [c.chunk_id for c in rows[0].citations] == ["c1", "c2"]
    assert rows[1].answer == A.NO_ANSWER and not rows[1].grounded and rows[1].citations == []
    audit = A.citation_audit(spark.createDataFrame(rows), spark.createDataFrame(hits, ddl)).collect()
    assert [(r.query_id, r.problem) for r in audit] == [(2, "no citation")]


def test_zero_padded_markers_and_deep_ranks(spark):
    """[Source 02] cites source 2, and neither rank nor position is bounded."""
    asked = spark.createDataFrame([(1, "q")], "query_id int, query string")
    ddl = "query_id int, rank int, chunk_id string, text string, source string, doc_id string, query string"
    hits = [(1, 2, "c2", "As [Source 02] says", "s", "d", "q"), (1, 3_000, "c3", "Last words", "s", "d", "q")]
    same = X.column_scorer(lambda q, t: F.lit(1.0))
    row = A.extractive_answers(spark.createDataFrame(hits, ddl), asked, same).first()
    assert row.answer == "As [Source 02] says [Source 2] Last words [Source 3000]"
    assert [c.chunk_id for c in row.citations] == ["c2", "c3"]
    only = spark.createDataFrame([("x [Source 007] y [Source 0]",)], "t string").select(A.cited_numbers(F.col("t")))
    assert only.first()[0] == ["7", "0"]


def test_order_keys_of_long_and_negative_ids(spark):
    long = ["a" * 25 + end for end in "cab"]
    rows = spark.createDataFrame([(i, "t", "s") for i in long], "doc string, text string, source string")
    assert [r.id for r in D.documents(rows, "doc").orderBy("ord_key").collect()] == sorted(long)
    numbers = [5, -3, 0, -(1 << 63), (1 << 63) - 1, 10]
    rows = spark.createDataFrame([(i, "t", "s") for i in numbers], "doc bigint, text string, source string")
    ordered = D.documents(rows, "doc").orderBy("ord_key").collect()
    assert [int(r.id) for r in ordered] == sorted(numbers) and len({len(r.ord_key) for r in ordered}) == 1
    with pytest.raises(PySparkException, match="text is null"):
        D.documents(rows.withColumn("text", F.lit(None).cast("string")), "doc").collect()


def test_prompt_column(spark):
    text = spark.range(1).select(A.prompt(F.lit("why?"), F.lit("[Source 1] x"))).first()[0]
    assert "CONTEXT:\n[Source 1] x\n\nQUESTION: why?\n\nANSWER:" in text and A.NO_ANSWER in text


def test_best_per_query_takes_ties_in_row_order():
    scores = np.array([[0.0, 2.0], [0.0, 1.0], [0.0, 2.0], [1.0, 2.0]])
    row, query, value = K.best_per_query(scores, np.arange(4), np.full(2, -np.inf), 2)
    assert list(zip(query, row, strict=True)) == [(0, 3), (0, 0), (1, 0), (1, 2)]
    row, query, value = K.best_per_query(scores, np.arange(4)[::-1], np.array([1.0, 2.0]), 2)
    assert list(zip(query, row, strict=True)) == [(0, 3), (1, 3), (1, 2)]


def test_scores_do_not_depend_on_groups_or_pieces(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(9)
    rows = [rnd.choices(WORDS, k=rnd.randrange(0, 30)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["tokens"])
    entries = [(q, w, rnd.random()) for q in range(7) for w in sorted(set(WORDS)) if rnd.random() < 0.6]
    table = pa.table(list(zip(*entries, strict=True)), names=["query_id", "term", "weight"])
    want = np.zeros((40, 7))
    for i, words in enumerate(rows):
        for q, w, weight in entries:
            tf = words.count(w)
            want[i, q] += weight * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(words) / 12.0))
    for group, cells in ((7, 10**6), (3, 10**6), (2, 1), (7, 25), (1, 60)):
        monkeypatch.setattr(B, "PRODUCT_CELLS", cells)
        weights = B._QueryWeights.of(table, list(range(7)), group)
        got = np.zeros((40, 7))
        for start, scores in B._score_batch(batch, weights, 12.0, 1.5, 0.75):
            got[:, start : start + scores.shape[1]] = scores
        assert np.allclose(got, want), (group, cells)


def test_bounds_leave_out_rows_and_no_hit(spark, monkeypatch):
    monkeypatch.setattr(V, "BOUND_CELLS", 256 * 32 * 10)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12)) * 4
    m = np.vstack([np.round(c + rng.normal(size=(40, 12)), 2) for c in centres] + [np.zeros((3, 12))])
    m = np.vstack([m, m[:30]])
    rows = vector_rows(spark, m).repartition(3)
    asked = rows.select(F.col("id").cast("bigint").alias("query_id"), "embedding")
    best = lambda found: sorted((r.query_id, r["rank"], r.id) for r in found.collect())
    want = best(V.dense_search(rows, asked, k=5))
    for pivots in (0, 1, 8, 40):
        basis = V.fit_pivots(rows, pivots) if pivots else np.zeros((0, 12))
        assert np.allclose(basis @ basis.T, np.eye(len(basis)))
        stored = V.with_bounds(rows, basis)
        assert best(V.bounded_search(stored, basis, asked, k=5)) == want
    work = V.bounded_work(stored, basis, asked, k=5).first()
    assert work.pairs == len(m) ** 2 and work.measured < 0.5 * work.pairs


def test_coded_clusters_are_pruned_and_rescored(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 10)) * 5
    m = np.vstack([c + rng.normal(size=(50, 10)) for c in centres])
    rows = vector_rows(spark, m)
    asked = rows.select(F.col("id").cast("bigint").alias("query_id"), "embedding")
    model = V.fit_clusters(rows, 8)
    coded, levels = V.with_codes(V.assign_clusters(rows, model), model)
    stored = V.write_clusters(coded, f"{tmp_path}/c")
    assert stored.count() == len(m)
    exact = V.dense_search(rows, asked, k=5)
    found = V.coded_search(stored, model, levels, asked, probes=2, rescored=25, k=5)
    assert V.recall(exact, found).first().recall > 0.95
    kept = {(r.query_id, r.id): r.score for r in exact.collect()}
    assert all(abs(kept[r.query_id, r.id] - r.score) < 1e-7 for r in found.collect() if (r.query_id, r.id) in kept)
    every = V.coded_search(stored, model, levels, asked, probes=8, rescored=400, k=5)
    assert V.recall(exact, every).first().recall == 1.0
    seen, blocks = [], V.search_blocks
    V.search_blocks = lambda b, f, s, rows, *rest: seen.append(rows) or blocks(b, f, s, rows, *rest)
    try:
        V.coded_search(stored, model, levels, asked.limit(1), probes=1, rescored=8).collect()
    finally:
        V.search_blocks = blocks
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*cluster", plan)
    assert len({r[0] for r in seen[0].select("cluster").distinct().collect()}) == 1


def test_bounded_scorer_looks_at_every_row_once_for_its_floor():
    """The k-th best score so far comes from the k best rows kept, not from all rows before."""
    rng = np.random.default_rng(5)
    rows, pivots = rng.normal(size=(3000, 8)), np.eye(8)[:4]
    scorer = V.BoundedScorer(rows[:3], pivots)
    scorer.k, seen, best = 5, [], scorer._best
    scorer._best = lambda scores: (seen.append(len(scores)), best(scores))[1]
    heads, tails = V._heads(rows, pivots)
    lists = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in (rows, heads)]
    batch = pa.RecordBatch.from_arrays([*lists, pa.array(tails)], names=["embedding", "head", "tail"])
    [(_, scores)] = list(scorer(batch, np.full(3, -np.inf)))
    assert np.allclose(np.sort(scores, axis=0)[-5:], np.sort(-V.squared_l2(rows, rows[:3]), axis=0)[-5:])
    assert scorer.measured < 0.8 * scorer.pairs
    assert sum(seen) < 3 * len(rows)
