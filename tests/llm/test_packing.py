"""Token pieces and their places, against the tokenizer and the definition of a packing."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from thermolake.llm import packing, tokens
from thermolake.llm.queries import TOKENIZER, op4_packing


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ALPHABET = st.sampled_from([*"abcXYZéñ ", " ", "\n", "\t", ".", ",", "'", "1", "\xa0", "中", "́", "😀", "%%%", " the", "Ġ", "'s"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), max_size=8))
def test_words_encode_as_whole_texts(texts):
    encoder = tokens.encoder(TOKENIZER)
    whole = [np.frombuffer(b, "<u4").tolist() for b in encoder._call(texts)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole  # from memory


def test_a_full_memory_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    encoder = tokens.Encoder(TOKENIZER)
    for _ in range(3):
        assert [i.tolist() for i in encoder.encode(["one two three.\nFour", None])] == [plain("one two three.\nFour"), []]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_is_a_packing(histogram):
    capacity = 60
    bins: dict[int, list[tuple[int, int]]] = {}
    for size in histogram:
        runs = [r for r in packing.plan(histogram, capacity).tolist() if r[0] == size]
        numbers = sorted(i for _, first, count, _, _ in runs for i in range(first, first + count))
        assert numbers == list(range(histogram[size]))
    for size, _, count, first_bin, offset in packing.plan(histogram, capacity).tolist():
        for i in range(count):
            bins.setdefault(first_bin + i, []).append((offset, size))
    for places in bins.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at  # gapless
            at += size
        assert at <= capacity and sum(3 * size > capacity for _, size in places) <= 2
    # At most one bin is half empty or worse: two such would have been one.
    assert len(bins) <= 2 * sum(s * n for s, n in histogram.items()) / capacity + 1


def test_large_pieces_take_the_longest_partner():
    assert packing.plan({600: 2, 424: 1, 400: 1}, 1024)[:, [0, 3, 4]].tolist() == [[600, 0, 0], [424, 0, 600], [600, 1, 0], [400, 1, 600]]


def test_pieces_cut_long_documents_only(odd_docs, plain):
    rows = packing.pieces(odd_docs, TOKENIZER).collect()
    expected = []
    for row in odd_docs.collect():
        ids = plain(row["text"]) + [2]
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        expected += [(row["doc_id"], i, a, np.array(ids[a:b], "<u4").tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: (str(r[0]), r[1], r[3])
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["ids"]) for r in rows], key=key) == sorted(expected, key=key)
    assert all(r["length"] * 4 == len(r["ids"]) for r in rows)


def test_sequences_are_gapless_and_hold_the_ids(odd_docs):
    packed = packing.pack(packing.pieces(odd_docs, TOKENIZER))
    rows = packed.collect()
    by_sequence: dict[int, list] = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    for places in by_sequence.values():
        places.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in places] == [sum(p["length"] for p in places[:i]) for i in range(len(places))]
        assert sum(r["length"] for r in places) <= 1024
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert whole == {k: b"".join(r["ids"] for r in v) for k, v in by_sequence.items()}


def test_query_over_the_whole_table(spark, sf_dir, some_docs, plain):
    rows = op4_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    found: dict[int, int] = {}
    for row in rows:
        ids = (plain(texts[row["doc_id"]]) + [2])[row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        found[row["doc_id"]] = found.get(row["doc_id"], 0) + row["length"]
    assert found == {k: len(plain(t)) + 1 for k, t in texts.items()}
    used = {r["sequence_id"] for r in rows}
    assert len(used) <= 1.02 * sum(found.values()) / 1024 + 1


def test_an_empty_table(no_docs):
    assert packing.pack(packing.pieces(no_docs, TOKENIZER)).count() == 0


def test_lengths_outside_the_capacity_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 2000)], "doc_id bigint, length bigint"))
