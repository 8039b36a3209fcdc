import base64
import gzip
import hashlib

import pytest

from snapflow.llm import arc_warc
from snapflow.llm.arc_warc import Unpacked, pages_to_warc, parse_arc, parse_warc, w3c_date

SCHEMA = "page_id long, url string, html string, payload string, record string"


def run(spark, data, **options):
    rows = spark.createDataFrame([(*r, "p", "r") for r in data], SCHEMA).repartition(3)
    return pages_to_warc(rows, **options).collect()


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    tricky = "http://a 0.0.0.0 20240101000000 text/html 5\nWARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\n"
    data = [
        (1, "http://x/é y", "<p>é</p>"), (2, None, None), (3, "u\nv", ""), (4, "http://x/", tricky), (5, "q", tricky),
        (6, "q", "long " * 50_000), (None, "n", "<p>é</p>"), (7, "q", tricky),
    ]
    got = {r["page_id"]: r for r in run(spark, data)}
    assert len(got) == len(data)
    last = {}
    for page, _, html in data:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    for page, _, html in data:
        r = got[page]
        assert r["payload_bytes"] == len((html or "").encode()) and r["payload_digest"] == digest(html)
        if page == last[html or ""]:
            assert r["record_type"] == "response" and r["refers_to"] is None
            assert bytes(r["payload"]) == (html or "").encode()
        else:
            assert r["record_type"] == "revisit" and r["refers_to"] == last[html or ""] and r["payload"] is None


def test_small_payloads_are_not_revisited(spark):
    data = [(1, "a", "same"), (2, "b", "same"), (3, "c", "longer same"), (4, "d", "longer same")]
    got = {r["page_id"]: r["record_type"] for r in run(spark, data, min_revisit_bytes=5)}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_repeated_rows_and_shuffled_table(spark, monkeypatch):
    keep = arc_warc.convert
    monkeypatch.setattr(arc_warc, "convert", lambda r, n: keep(r, n, broadcast_rows=0))
    got = run(spark, [(1, "a", "x"), (1, "a", "x"), (2, "b", "y")])
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == [(1, "response", None), (1, "revisit", 1), (2, "response", None)] or len(got) == 3


def test_empty_table(spark):
    assert run(spark, []) == []


def test_arc_versions():
    one = b"filedesc://a 0.0.0.0 19960923142103 text/plain 20\n1 0 Org\nURL IP-addre\nhttp://h/ 1.2.3.4 19960923142103 text/html 6\nab\ncd\n\n"
    records = list(parse_arc(Unpacked(gzip.compress(one))))
    assert [(r["url"], r["content"]) for r in records] == [("http://h/", b"ab\ncd\n")]
    content = b"HTTP/1.0 200 OK\r\n\r\nhi"
    check = hashlib.md5(content).hexdigest().encode()
    two = b"filedesc://b 0.0.0.0 19970923142103 text/plain 200 - - 0 b 6\n2 0 Or\nhttp://h/ 1.2.3.4 19970923142103 text/html 200 %s - 90 b %d\n%s\n"
    parts = [gzip.compress(p) for p in ((two % (check, len(content), content))[:70], (two % (check, len(content), content))[70:])]
    records = list(parse_arc(Unpacked(b"".join(parts))))  # two gzip members
    assert records[0]["status"] == "200" and records[0]["content"] == content
    with pytest.raises(ValueError):
        list(parse_arc(Unpacked(gzip.compress(two % (b"0" * 32, len(content), content)))))
    with pytest.raises(ValueError):
        list(parse_arc(Unpacked(gzip.compress(one[:-6]))))
    assert w3c_date("19960923142103") == "1996-09-23T14:21:03Z"


def test_warc_needs_its_end():
    with pytest.raises(ValueError):
        list(parse_warc(Unpacked(gzip.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\nXX"))))
