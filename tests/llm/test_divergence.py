"""Source divergence against sums over every term of every pair."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from thermolake.llm import divergence
from thermolake.llm.queries import op11_source_divergence

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, n bigint, block string, value string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, None, "x", 1, "x", "x") for r in rows], DDL)


def brute(rows, least=10, top=10):
    rows = [[r[1] or "", r[2] or "", r[3] or ""] for r in rows]
    counts, docs = {}, Counter()
    for text, lang, source in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts.setdefault((lang, source), Counter()).update(words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [w for (l, w), n in docs.items() if l == lang and n >= least]
        groups = {s: c for (l, s), c in counts.items() if l == lang}

        def share(c):
            total = sum(c[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 2) // total for w in kept}

        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in groups if o != s]
            terms = [(f(p[s][w], q[w]), w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:last]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def audited(frame, **options):
    found = divergence.audit(frame, **options)
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found.collect())


@pytest.fixture
def random_rows():
    rng = random.Random(5)
    words = ["the", "The", "of", "é", "É", "naïve", "中文", "😀", "x1y", "a-b"] + [f"w{chr(97 + i)}" for i in range(25)]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", "", None, "Ä"])
        text = " ".join(rng.choices(words, weights=[30] + [3] * (len(words) - 1), k=rng.randint(0, 30)))
        rows.append((i % 300, rng.choice([text, text, text, None, "", "12 34"]), lang, source))
    rows += [(1000 + i, "only here once", "xx", "alone") for i in range(3)]
    rows += [(2000, None, "empty", "one"), (2001, "", "empty", "two"), (2002, "word", "empty", "three")]
    return rows + rows[:40]


@pytest.mark.parametrize("block,visits,gathered", [(200_000, 1_000_000, 400_000), (7, 3, 5)])
def test_equals_sums_over_all_terms(spark, random_rows, monkeypatch, block, visits, gathered):
    for name, value in (("BLOCK_ENTRIES", block), ("VISITS", visits), ("GATHERED", gathered)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(docs_of(spark, random_rows)) == brute(random_rows)


def test_ties_are_ranked_by_bytes(spark):
    rows = [(i, " ".join(f"{c}{c}" for c in "abcdefghijklmn") + " \U0001f600 ￮", "en", "one") for i in range(10)]
    rows += [(99, "zz", "en", s) for s in ("\U0001f600", "￮", "B", "a")]
    found = audited(docs_of(spark, rows))
    assert found == brute(rows)
    assert [r[3] for r in sorted(found, key=lambda r: r[5]) if r[:3] == ("en", "one", "pair")] == ["B", "a", "￮", "\U0001f600"]


def test_an_empty_table(spark):
    assert audited(docs_of(spark, [])) == []


def test_odd_rows(spark, odd_docs):
    rows = [tuple(r[:4]) for r in odd_docs.collect()]
    assert audited(odd_docs, least=2) == brute(rows, least=2)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    found = sorted(tuple(r) for r in op11_source_divergence(spark, sf_dir).select("lang", "source", "part", "item", "value", "rank").collect())
    assert found == brute(rows)


def test_counts_beyond_64_bits():
    for n, total in itertools.product([0, 9_223_372_034, 9_223_372_035, 10**12, 10**17], [10**17 + 5, 3 * 10**18]):
        assert divergence.shares(np.array([n]), total)[0] == 1 + 10**9 * (n + 2) // total
    assert divergence.shares(np.array([5, 10**15]), np.array([7, 10**16])).tolist() == [1 + 10**9, 1 + 10**9 * (10**15 + 2) // 10**16]


def test_accumulators_not_postings_are_emitted(spark):
    """Many shared terms give one row per pair and block."""
    import pyarrow as pa

    terms, sources = [f"t{i}" for i in range(500)], [f"s{i}" for i in range(6)]
    cells = [("en", s, t, 1, 1500, 4000) for t in terms for s in sources]
    block = pa.table([pa.array(c) for c in zip(*cells)], names=["lang", "source", "term", "n", "total", "lang_total"])
    pairs = [b for b in divergence.accumulate(block) if b.num_rows and b.column("part")[0].as_py() == "pair"]
    assert sum(b.num_rows for b in pairs) == 6 * 5
