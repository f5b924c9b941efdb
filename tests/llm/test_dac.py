"""Directly addressable codes: exact round trips and random access."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from thermolake.llm import dac
from thermolake.llm.queries import TOKENIZER, op6_token_files


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 255, 256, 50_256, 65_535, 65_536, 1 << 24, (1 << 32) - 1]) | st.integers(0, (1 << 32) - 1), min_size=1, max_size=300), st.data())
def test_any_id_is_read_alone(ids, data):
    file = dac.DacFile(dac.encode(np.array(ids, np.uint32), [None, 7], np.array([0, len(ids) // 2])))
    places = data.draw(st.lists(st.integers(0, len(ids) - 1)))
    assert file.take(np.array(places, np.int64)).tolist() == [ids[p] for p in places]
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    assert file.span(a, b).tolist() == ids[a:b]
    assert file.document(0).tolist() == ids[: len(ids) // 2] and file.document(1).tolist() == ids[len(ids) // 2 :]
    assert file.null_ids.tolist() == [True, False] and file.doc_ids[1] == 7


def test_another_file_is_refused():
    with pytest.raises(ValueError):
        dac.DacFile(b"something else")


def expected(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    out, start = [], 0
    for row in rows:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        out.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_over_the_whole_table(spark, sf_dir, some_docs):
    rows = op6_token_files(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == expected(some_docs.collect())


@pytest.mark.parametrize("file_ids", [1, 50, 10_000_000])
def test_odd_rows_in_files_of_any_size(odd_docs, file_ids):
    read = dac.read(dac.write(odd_docs, TOKENIZER, file_ids=file_ids))
    rows = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in read.collect()]
    assert sorted(rows, key=lambda r: r[1]) == expected(odd_docs.select("doc_id", "text").collect())


def test_an_empty_table(no_docs):
    manifest = dac.write(no_docs, TOKENIZER)
    assert manifest.count() == 0 and dac.read(manifest).count() == 0
