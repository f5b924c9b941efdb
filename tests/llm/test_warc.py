"""WARC bundles: what is written is read back, by place and as a whole archive."""

import base64
import hashlib
import io

import pytest
import zstandard

from thermolake.llm import warc
from thermolake.llm.queries import op10_warc

DDL = "record_id bigint, url string, payload binary, sha1 string"


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, min_bytes=0):
    rows = [(r[0], bytes(r[2] or b"")) for r in rows]
    first = {}
    for key, payload in rows:
        if key is not None:
            first[payload] = min(key, first.get(payload, key))
    out = []
    for key, payload in rows:
        refers = first[payload] if key is not None and len(payload) >= min_bytes and first[payload] < key else None
        out.append((key, len(payload), sha1(payload), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/\r\nx", b"same", "clash"),
    (2, "http://b", b"same", None),
    (2, "http://b", b"same", None),
    (9, None, b"same", None),
    (3, "http://c", b"", None),
    (4, "http://d", None, None),
    (None, "http://e", b"same", None),
    (None, None, None, None),
    (7, "http://f?a=b: c", b"\x00\xff\r\n\r\nWARC/1.1\r\n" * 20_000, None),
    (8, "http://g", "é😀".encode() * 7, None),
]


@pytest.mark.parametrize("min_bytes,frame,size", [(0, 1, 1), (0, 100, 10_000_000), (1, 300_000, 1 << 26), (5, 64, 200)])
def test_round_trip(spark, min_bytes, frame, size):
    index = warc.write(spark.createDataFrame(ROWS, DDL), min_bytes, frame, size)
    rows = warc.read(index).collect()
    found = [(r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(found, key=str) == expected(ROWS, min_bytes)
    bodies = {(r["record_id"], bytes(r["body"])) for r in rows if r["record_type"] == "response"}
    assert all((k, bytes(p or b"")) in bodies for k, _, p, _ in ROWS if k in (None, 2, 7, 8))
    assert all(r["body"] == b"" for r in rows if r["record_type"] == "revisit")


def test_any_zstd_reader_sees_the_whole_archive(spark):
    index = warc.write(spark.createDataFrame(ROWS, DDL).coalesce(1), frame_bytes=100).collect()
    for path in {r["path"] for r in index}:
        data = warc.open_file(path).read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        at, bundle = 0, warc.Bundle(path)
        own = sorted((r for r in index if r["path"] == path), key=lambda r: (r["frame"], r["offset"]))
        assert len(bundle.sizes) == len({r["frame"] for r in own})
        for row in own:
            assert whole[at : at + row["length"]] == bundle.frame(row["frame"])[row["offset"] : row["offset"] + row["length"]]
            at += row["length"]
        assert at == len(whole)


def test_a_damaged_record_is_refused():
    good = warc.record(1, "http://a", b"body", hashlib.sha1(b"body").hexdigest(), None)
    headers, body = warc.parse(good)
    assert body == b"body" and headers["WARC-Target-URI"] == "http://a" and headers["WARC-Record-ID"] == "<urn:x-record:1>"
    for bad in (good[:-3], b"HTTP" + good):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_query_over_the_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    rows = op10_warc(spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == expected([(r["page_id"], None, (r["html"] or "").encode()) for r in pages])


def test_an_empty_table(spark):
    index = warc.write(spark.createDataFrame([], DDL))
    assert index.count() == 0 and warc.read(index).count() == 0
