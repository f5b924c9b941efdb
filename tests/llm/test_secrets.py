"""Secret scans against Python's own regular expressions over whole texts."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermolake.llm import secrets as S
from thermolake.llm.queries import op8_secrets
from thermolake.llm.trigrams import trigram_query


def brute(text):
    found = []
    for place, rule in enumerate(S.RULES):
        for match in re.finditer(rule.pattern, text or ""):
            if len(match[rule.group]) >= rule.least:
                found.append((match.start(), place, rule.kind, match.end()))
    return sorted(found)


def brute_marked(text):
    for rule in S.MORE + S.BASE:
        if text is not None:
            text = re.sub(rule.pattern, lambda m: S.MARK if len(m[rule.group]) >= rule.least else m[0], text)
    return text


HEX = "0123456789abcdef"
TEXTS = [
    "password=abcdef and password = abcde and PASSWD: 'abcdefg' api_key=\"xyz-123/4\" ApiKey:zzzzzz",
    "é😀 token=abc secret=token=abcdef AKIA" + "A1" * 8 + " AKIASHORT " + HEX * 2 + "g" + HEX + " " + HEX[:8] * 3,
    HEX * 3 + HEX * 3,
    "token=" + HEX * 2 + "," + "AKIA" + "B" * 30 + "xox",
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " xoxb-1234567890ab AIza" + "b" * 35 + " eyJab.eyJcd.sig_-1",
    "AKIA" + "C" * 16 + "\n" * 3 + "secret:\nabcdef token:abcdef",
    ("token=abcdefg " * 3_000) + HEX * 2,
    "toke n pass word aki a",
    "",
    None,
]


@pytest.fixture(scope="module")
def secret_docs(spark):
    rows = [(i, text, "x") for i, text in enumerate(TEXTS)] + [(0, TEXTS[0], "y"), (None, TEXTS[1], None), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, found string")


def test_scan_equals_brute_force(secret_docs, odd_docs):
    for docs in (secret_docs, odd_docs):
        rows = S.scan(docs).select("doc_id", S.written("found").alias("spans")).collect()
        expected = [(r["doc_id"], ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute(r["text"]))) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))


def test_redact_equals_brute_force(secret_docs, odd_docs):
    for docs in (secret_docs, odd_docs):
        marked = S.redact(docs)
        assert marked.columns == docs.columns
        expected = [tuple(r.asDict() | {"text": brute_marked(r["text"])} for r in [row])[0] for row in docs.collect()]
        assert sorted(map(str, (r.asDict() for r in marked.collect()))) == sorted(map(str, expected))


def test_query_over_the_whole_table(spark, sf_dir, some_docs):
    rows = {r["doc_id"]: r for r in op8_secrets(spark, sf_dir).collect()}
    assert len(rows) == some_docs.count()
    for doc in some_docs.collect():
        found, row = brute(doc["text"]), rows[doc["doc_id"]]
        write = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        base = [s for s in found if s[1] < 3]
        assert row["spans"] == write(found)
        assert row["base_sha256"] == hashlib.sha256(write(base).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]


def test_no_python_in_the_plan(spark, sf_dir, some_docs):
    plan = S.scan(some_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_an_empty_table(no_docs):
    assert S.scan(no_docs).count() == 0 and S.redact(no_docs).count() == 0


PATTERNS = [rule.pattern for rule in S.RULES] + ["abc|abd?e", "(abc){2}x", "(?i)Foo[ab]r", "a.c", "x*abcd+ef", "(ab|cd)(ef|gh)", "abc{3}d", "^abc$"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_match_fulfils_its_trigram_query(pattern):
    clauses = trigram_query(pattern)

    @settings(max_examples=60, deadline=None)
    @given(st.from_regex(pattern))
    def holds(text):
        match = re.search(pattern, text)
        lower = match[0].lower()
        assert any(all(t in lower for t in clause) for clause in clauses)

    holds()


def test_queries_are_as_strict_as_expected():
    assert trigram_query("abc|abd") == [frozenset({"abc"}), frozenset({"abd"})]
    assert trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert trigram_query("abc(de)?") == [frozenset({"abc"})]
    assert trigram_query("[0-9a-f]+") == [frozenset()]
    assert S.plan_rules(S.BASE)[1] == [S.BASE[2]]


def covered(text):
    """Original spans, overlapping ones as one."""
    merged = []
    for start, _, _, end in brute(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


OVERLAPS = [
    "api_key=AIza" + "b" * 35 + "TailOfTheSecret99 after",
    "é😀 token=ghp_" + "a1" * 18 + "/Rest+Of.Secret==, after",
    "secret=pw1.xoxb-1234567890, ü after",
    "password=AKIA" + "Z9" * 9 + "/" + HEX * 2 + "+tail/é secret:=short token=abcdefg",
    "token=abcdef " + HEX * 2,
]


def test_nothing_of_any_span_is_left(spark):
    docs = spark.createDataFrame(list(enumerate(OVERLAPS)), "doc_id bigint, text string")
    marked = {r["doc_id"]: r["text"] for r in S.redact(docs).collect()}
    for i, text in enumerate(OVERLAPS):
        ranges, expected, at = covered(text), "", 0
        for start, end in ranges:
            expected, at = expected + text[at:start] + S.MARK, end
        assert ranges and marked[i] == expected + text[at:]
    assert marked[0] == "[SECRET] after" and marked[2] == "[SECRET], ü after"


LINES = ["MIIEowIBAAKCAQEA" + "x7/+Q" * 9 + "abc"] * 3 + ["Zm9v+/Q="]
HEAD, TAIL = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
KEYS = [
    "\n".join([HEAD, *LINES, TAIL]),
    " ".join([HEAD, *LINES, TAIL]),
    "\\n".join([HEAD, *LINES, TAIL]),
    "\r\n".join([HEAD, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,3F17F5316E2BAC89", "", *LINES, TAIL]),
    "\n".join([HEAD, *LINES]),
    "\n".join([HEAD, *LINES[:2], "MIIEo"]),
    "\n".join([HEAD, *LINES * 20_000, TAIL]),
    "\n".join([HEAD, *LINES[:3] * 20_000]),
    HEAD,
]


def test_private_keys_are_marked_to_their_end(spark):
    afters = ["" if key.endswith("MIIEo") else " and é (prose) goes on" for key in KEYS]
    texts = ["before " + key + after for key, after in zip(KEYS, afters)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in S.scan(docs).select("doc_id", S.written("found").alias("spans")).collect()}
    marked = {r["doc_id"]: r["text"] for r in S.redact(docs).collect()}
    for i, (key, after) in enumerate(zip(KEYS, afters)):
        assert f"private_key:7:{7 + len(key)}" in found[i].split(",")
        assert marked[i] == "before " + S.MARK + after
        assert found[i] == ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute(texts[i]))


def test_short_runs_are_not_carried(spark):
    assert S.BASE[2].searched() == "[0-9a-f]{24,}" and [r.searched() for r in S.BASE[:2]] == [r.pattern for r in S.BASE[:2]]
    text = " ".join([HEX[:8], HEX * 2, HEX[:5] + "-" + HEX, "g" + HEX[:12] * 2 + "g"])
    docs = spark.createDataFrame([(1, text), (2, HEX)], "doc_id bigint, text string")
    found = S.hits(S.keyed(docs), [S.BASE[2]], None).collect()
    assert [(r["_scan_id"], r["found"]) for r in found] == [(1, [32, 24])]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0af-g", max_size=40), st.integers(1, 6))
def test_a_searched_class_finds_the_long_runs(text, least):
    rule = S.Rule("run", "[0-9a-f]+", least)
    long = [m.span() for m in re.finditer(rule.pattern, text) if len(m[0]) >= least]
    assert [m.span() for m in re.finditer(rule.searched(), text)] == long
