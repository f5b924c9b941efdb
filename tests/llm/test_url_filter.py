"""URL verdicts: rules, references, aliases, and a brute-force version of all of it."""

import re
from urllib.parse import urljoin

import duckdb
import pytest

from thermolake.llm import url_filter
from thermolake.llm.oracles import URL_FILTER
from thermolake.llm.queries import URL_RULES, op12_url_filter

DDL = "page_id bigint, url string, html string, host string, rule string, node string, component string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], DDL)


def canonical(href):
    return f'<html><head><LINK rel="alternate canonical" href="{href}"></head>'


def refresh(url):
    return f'<meta content="0; URL={url}" http-equiv=Refresh>'


def split(url):
    if url is None or "://" not in url:
        return "", ""
    found = re.match(r"([^/?#]*)([^?#]*)", url.partition("://")[2])
    return "".join(c.lower() if c.isascii() else c for c in found[1]), found[2]


def ruled(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "allow"), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


PAGES = [
    (1, "http://a.com/x", canonical("https://b.net/y")),  # alias of a blocked address
    (2, "https://A.com/x#part", None),  # the same address as 1
    (3, "http://c.org/fr/1", canonical("http://a.com/x")),  # allowed by rule, whatever it is an alias of
    (4, "http://d.com/1", canonical("http://c.org/fr/1")),  # blocked through the allowed one
    (5, "http://e.example.net/en/1", refresh("http://f.com/")),  # an allow rule does not spread a block
    (6, "http://f.com", ""),
    (7, "http://g.com/dir/sub/p.html", canonical("../../h/./q?x=1&amp;y=2")),
    (8, "http://g.com/h/q?x=1&y=2", refresh("//www.example.com/de/z")),  # 7 and 8 go with /de/
    (9, "http://i.com/a", "<!-- " + canonical("http://b.net/") + " -->" + '<script>"<link rel=canonical href=http://b.net/>"</script>'),
    (10, "http://j.com/a", canonical("mailto:x@b.net") + canonical("#top") + canonical("") + refresh("javascript:void(0)")),
    (11, "http://k.com/a?p=1", "<link href='?p=2' rel=canonical>"),
    (12, "http://k.com/a?p=2", "<link href=/blocked rel='canonical'>"),
    (13, "http://k.com/blocked", refresh("'http://sub.example.com/de/'")),
    (14, "http://l.com/a?p=1", canonical("b")),
    (15, "http://net/", None),
    (16, "http://internet/", None),
    (17, "http://x.example.net/en", None),
    (18, "http://x.example.net/en/", None),
    (19, None, canonical("http://b.net/")),
    (20, "no scheme", canonical("http://b.net/")),
    (None, "http://m.com/?u=http://b.net/", None),
    (1, "http://a.com/x", canonical("https://b.net/y")),
    (22, "http://n.com:80/a/b/..", canonical("http://b.net")),
    (23, "http://n.com:80/a/", None),
    (24, "ftp://o.com?q/r#s?t", "x" * 200_000 + refresh("http://b.net/") + "<" * 1000),
    (25, "http://ÄB.org/fr/ü", canonical("http://q.com/\n")),
]
BLOCKED = {1, 2, 4, 7, 8, 11, 12, 13, 15, 17, 22, 23, 24}


def test_verdicts(spark):
    judged = url_filter.judge(rows_of(spark, PAGES), url_filter.rule_table(spark, URL_RULES)).collect()
    assert len(judged) == len(PAGES)
    assert {r["page_id"] for r in judged if r["verdict"] == "block"} == BLOCKED
    for r in judged:
        assert (r["host"], r["path"]) == split(r["url"])
        rule, verdict = ruled(r["host"], r["path"])
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict)


def test_sql_spreads_blocks_alike(spark, tmp_path):
    rows_of(spark, PAGES).select("page_id", "url", "html").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(URL_FILTER).fetchall()
    got = [tuple(r) for r in op12_url_filter(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("reference", ["b", "../b", "../../../b", "./", "..", ".", "/a/./b/../c", "?q", "//h.com/x", "a/b/../../c?d/../e"])
def test_references_resolve_as_urls_do(spark, reference):
    base = "http://a.com/one/two/three?four"
    row = spark.createDataFrame([(base, reference)], "base string, ref string").select(
        url_filter.address(url_filter.resolved(*map(spark_col, ("base", "ref")))).alias("found")
    )
    want = urljoin(base, reference).partition("://")[2]
    assert row.first()["found"] == want


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_long_chains_and_hubs_against_a_search(spark):
    """A chain of 40, a hub with 300 spokes, and a crawler's log of redirects."""
    chain = [(i, f"http://chain.com/{i}", canonical(f"http://chain.com/{i + 1}")) for i in range(40)]
    spokes = [(1000 + i, f"http://s{i}.com/", canonical("http://hub.com/")) for i in range(300)]
    clean = [(2000 + i, f"http://clean.com/{i}", canonical(f"http://clean.com/{i // 2}")) for i in range(50)]
    log = spark.createDataFrame(
        [("http://chain.com/40", "http://x.net/"), ("http://hub.com/", "http://example.com/de/"), (None, "http://x.net/"), ("http://clean.com/1", None)],
        "url string, target string",
    )
    pages = rows_of(spark, [*chain, *spokes, *clean])
    judged = url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES), log).collect()
    assert {r["page_id"] for r in judged if r["verdict"] == "block"} == {r[0] for r in [*chain, *spokes]}


def test_equal_rules_allow(spark):
    rules = [url_filter.Rule("a.com", "/", "block"), url_filter.Rule("a.com", "/", "allow"), url_filter.Rule("b.a.com", "/", "block")]
    pages = rows_of(spark, [(1, "http://a.com/", None), (2, "http://c.b.a.com/x", None), (3, "http://ba.com/", None)])
    judged = url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in judged} == {1: ("a.com/", "allow"), 2: ("b.a.com/", "block"), 3: (None, "allow")}
    none = url_filter.judge(pages, url_filter.rule_table(spark, [])).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_an_empty_table(spark):
    assert url_filter.judge(rows_of(spark, []), url_filter.rule_table(spark, URL_RULES)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op12_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
