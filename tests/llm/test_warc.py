"""Archives, index and lookups against the pages they were made from."""

import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textmart.llm import warc

SCHEMA = "page_id LONG, url STRING, html STRING, key STRING, size LONG, response LONG"


def pages(seed=2):
    rnd = random.Random(seed)
    bodies = ["", "short", "é" * 600, "x" * 1000, "y" * 999, "z" * 5000, "\r\n\r\n" * 500, None]
    urls = ["http://www.Example.com/a?b=1#c", "https://user@example.com:8080", "http://example.com/ä b\tc", "no scheme", None, "", "http://b.org/\r\nx"]
    rows = [(i, rnd.choice(urls), rnd.choice(bodies), "clash", 1, 2) for i in range(60)]
    rows += [rows[3], rows[3], (7, "http://b.org/", "z" * 5000, None, None, None), (None, "http://b.org/", "z" * 5000, None, None, None), (None, None, "w" * 2000, None, None, None)]
    return rows


def brute(rows):
    top = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            top[html or ""] = max(top.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        other = top.get(html or "") if len(data) >= 1000 else None
        revisit = other is not None and other != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_equals_the_pages(spark, broadcast_rows):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = warc.archived(df, broadcast_rows=broadcast_rows)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_payloads_that_are_a_small_part_meet_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(warc, "HEAVY", 3)
    rows = pages(4)
    assert Counter(map(tuple, warc.archived(spark.createDataFrame(rows, SCHEMA), broadcast_rows=0).collect())) == brute(rows)


def test_no_rows(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lookups_in_small_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 400)
    rows = [(i, f"http://h{i % 7}.example.com/p{i % 40}", f"body {i}", None, None, None) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    captures = warc.write_archives(df, f"{tmp_path}/archives")
    index = warc.build_index(captures, f"{tmp_path}/index", f"{tmp_path}/archives", block_lines=3, file_lines=20)
    assert index.firsts == sorted(index.firsts) and len(index.files) > 5
    directories = [line for f in Path(f"{tmp_path}/index").glob("*.dir") for line in f.read_text().splitlines()]
    assert 400 / 3 <= len(directories) <= 400 / 3 + len(index.files)
    keys = spark.createDataFrame([(u,) for u in ["http://H3.example.com/p3", "http://h1.example.com/p1", "http://h1.example.com/p10000", "http://zz/", "http://a/"]], "url STRING").select(warc.url_key(F.col("url")).alias("key"))
    found = warc.read_records(warc.lookup(keys, index), index).collect()
    want = {str(r[0]): r for r in rows if r[1] in ("http://h3.example.com/p3", "http://h1.example.com/p1")}
    assert {r.page_id: (r.url, bytes(r.payload).decode(), r.record_type) for r in found} == {k: (r[1], r[2], "response") for k, r in want.items()}
    assert len(found) == len(want)


def test_archives_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.b/", "q" * 2000), (2, "http://a.b/", "q" * 2000)], "page_id LONG, url STRING, html STRING").coalesce(1)
    captures = warc.write_archives(df, f"{tmp_path}/archives").collect()
    data = b"".join(gzip.decompress(f.read_bytes()) for f in Path(f"{tmp_path}/archives").glob("*.warc.gz"))
    assert data.count(b"WARC/1.1\r\n") == 2 and data.count(b"q" * 2000) == 1
    revisit = next(p for p in data.split(b"WARC/1.1\r\n")[1:] if b"WARC-Type: revisit" in p)
    other = next(p for p in data.split(b"WARC/1.1\r\n")[1:] if b"WARC-Type: response" in p)
    name = revisit.split(b"WARC-Refers-To: ")[1].split(b"\r\n")[0]
    assert b"WARC-Record-ID: " + name + b"\r\n" in other
    assert {c.key for c in captures} == {"b,a)/ 1", "b,a)/ 2"}


def test_a_damaged_record_is_refused():
    member = warc.record("1", "http://a/", b"payload", hashlib.sha1(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(member)
    assert warc.parsed(warc.record("-", None, b"p", hashlib.sha1(b"p").hexdigest(), None)).page_id is None
