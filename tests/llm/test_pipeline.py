"""Stages against brute force, each on its own input."""

import pytest

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute as overlap
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_secrets import brute_marked
from thermolake.llm import toxicity
from thermolake.llm.common import stored, table
from thermolake.llm.queries import known_labels


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and result of every stage."""
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in P.STAGES:
        result = stored(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in result.collect()])
        docs = result
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_toxic_documents_go(spark, sf_dir, stages):
    before, after = stages["toxicity"]
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, known_labels(spark, sf_dir, "toxic", 3, 1))
    scores = model.score([r["text"] for r in before])
    cut = [model.by_language.get(r["lang"], model.threshold) for r in before]
    assert after == [r for r, s, c in zip(before, scores, cut) if s < c]


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    assert ids(after) == sorted({component for _, _, component in groups([(r["doc_id"], r["text"]) for r in before])})
    assert len(after) < len(before) and all(r in before for r in after)


def test_contaminated_documents_go(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    kept = set(ids(after))
    assert all(r in before for r in after) and 0 < len(after) < len(before)
    short = [r for r in before if len(r["text"]) < 1200]
    assert all((r["doc_id"] in kept) == (not any(overlap(r["text"], item) for item in items)) for r in short)


def test_secrets_are_marked(stages):
    before, after = stages["secrets"]
    texts = {r["doc_id"]: brute_marked(r["text"]) for r in before}
    expected = [r | {"text": texts[r["doc_id"]], "n_chars": len(texts[r["doc_id"]])} for r in before]
    by_id = lambda r: r["doc_id"]
    assert sorted(after, key=by_id) == sorted(expected, key=by_id)


def test_everything_kept_is_packed(stages):
    before, after = stages["packing"]
    assert sorted({r["doc_id"] for r in after}) == ids(before)
    used = {}
    for row in after:
        used.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in used.values():
        assert sum(n for _, n in places) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:]))


def test_columns_stay(spark, sf_dir, stages):
    columns = table(spark, sf_dir, "documents").columns
    assert all(list(after[0]) == columns for name, (_, after) in stages.items() if name != "packing")


def test_run_is_the_chain_of_stages(spark, sf_dir, stages):
    place = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(place, P.run(spark, sf_dir).collect())) == sorted(map(place, stages["packing"][1]))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_odd_rows_and_empty_tables(spark, sf_dir, odd_docs, no_docs, name, stage):
    assert stage(spark, no_docs, sf_dir).count() == 0
    out = stage(spark, odd_docs, sf_dir)
    if name != "packing":
        assert out.columns == odd_docs.columns
    assert {r["doc_id"] for r in out.collect()} >= {None, 1, 3, 4, 5, 6, 7, 9}
