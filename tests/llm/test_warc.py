import base64
import gzip
import hashlib
import io

import pytest

from tidemark.llm import warc
from tidemark.session import scratch_path

BIG = "<p>" + "long " * 60000
ROWS = [(3, "http://a/b c\r\nd", "<p>é"), (1, "http://a", "<p>é"), (2, None, None), (5, "http://e", ""), (7, "u", "x"), (9, "u", BIG), (8, "u", BIG), (None, "n", "<p>é"), (None, "n", "alone"), (4, "t", "tie"), (4, "t", "tie")]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        refers = f if f is not None and f != i and len(b) >= least else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,broadcast", [(0, 200_000), (2, 0)])
def test_round_trip(spark, monkeypatch, least, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    pages = spark.createDataFrame([(*r, "z", 1) for r in ROWS], "page_id long, url string, html string, same string, path int").repartition(3)
    manifest = warc.write_archives(pages, scratch_path(spark, "warc"), least)
    assert manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = warc.read_archives(manifest, payloads=True).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == expected(ROWS, least)
    assert all(r.verified for r in got)
    assert {r.payload for r in got if r.record_type == "response"} == {(h or "").encode() for _, _, h in ROWS}
    assert next(r.url for r in got if r.page_id == 3) == "http://a/b%20c%0D%0Ad"


def test_archives_are_plain_gzip_and_damage_is_seen(spark):
    data = b"".join(warc.member(warc.record(i, "u", b"body%d" % i * 40000, None, "2000-01-01T00:00:00Z")) for i in range(3))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3
    assert [r["payload"] for r in warc.read_archive(io.BytesIO(data))] == [b"body%d" % i * 40000 for i in range(3)]
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-9])))
    bad = warc.member(warc.record(1, "u", b"body", None, "d").replace(b"body", b"bodY"))
    assert [r["verified"] for r in warc.read_archive(io.BytesIO(bad))] == [False]
    short = warc.member(warc.record(1, "u", b"body", None, "d").replace(b"Content-Length: 4\r", b"Content-Length: 4\r")[:-3])
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(short)))


def test_header_of_any_length_and_clashing_columns(spark):
    rows = [(1, "http://a/" + "é" * 700_000, "x" * 3_000_000, "k", 2), (2, "http://b", "x" * 3_000_000, "k", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, first int")
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages, scratch_path(spark, "warc"))).collect()}
    assert got[1].url == rows[0][1] and all(r.verified for r in got.values())
    assert (got[1].payload_bytes, got[2].refers_to) == (3_000_000, 1)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, scratch_path(spark, "warc"))).collect() == []
