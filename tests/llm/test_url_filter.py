import re

import pytest
import textmart.llm.url_filter as url_filter
from textmart.llm.url_filter import judge_urls

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("a.b/xy", "block"), ("b/abcd", "allow"), ("dup/", "allow"), ("dup/", "block"), ("noslash", "block")]
URLS = [
    "http://x.example.org/es/1", "https://EXAMPLE.org/en/17?x", "https://example.org/en/2", "http://notexample.org/es/", "ftp://q.com/de/a#b", "http://com/de/", "http://q.com?de/", "http://q.com#x/de/", "http://q.com",
    None, "", "no scheme/com/de/", "://com/fr/x", "http://a.b/xyz", "http://a.b/abcdxy", "http://..com/fr/", "http://dup/x", "http://" + "s." * 300 + "org/" + "p" * 5000, "http://q.com/de/a://b.org/", "http://user@h.org:80/x", "http://q.com/de/\nnext",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate({i: i + 32 for i in range(65, 91)})
    best = None
    merged = {}
    for rule, verdict in rules:
        merged[rule] = max(verdict, merged.get(rule, verdict))
    for rule, verdict in merged.items():
        if "/" not in rule or not host:
            continue
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(rule), len(h), [-ord(c) for c in rule])
            if best is None or rank > best[0]:
                best = (rank, rule, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("shard_bytes", [1 << 20, 40])
def test_rules_against_brute_force(spark, shard_bytes):
    pages = spark.createDataFrame([(i, u, "old", "old") for i, u in enumerate(URLS + URLS)], "page_id int, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules, shard_bytes=shard_bytes).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(URLS + URLS)}


def test_colliding_digests_are_told_apart(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(url_filter, "xxh64_intdigest", lambda text: 7)
    names = sorted(["a/", "b/", "c/x"])
    import numpy as np

    path = tmp_path / "rules.bin"
    text = [n.encode() for n in names]
    parts = [np.array([3], "<i8"), np.full(3, 7, "<u8"), np.cumsum([len(t) for t in text], dtype="<i8"), np.array([0, 1, 0], np.uint8)]
    path.write_bytes(b"".join(p.tobytes() for p in parts) + b"".join(text))
    shard = url_filter.Shard(str(path))
    assert shard.find([b"c/x", b"q/", b"a/"]).tolist() == [2, -1, 0]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    rules = spark.createDataFrame([], "rule string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, rules).collect()] == [(1, "http://a.org/", "a.org", "/", None, "allow")]
    assert judge_urls(pages.limit(0), rules).collect() == []


def test_many_files_are_probed_in_one_stage(spark):
    rules = spark.range(2000).selectExpr("concat('h', id, '.org/p') AS rule", "if(id % 2 = 0, 'allow', 'block') AS verdict")
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://x.h', id, '.org/p', id) AS url")
    judged = judge_urls(pages, rules, shard_bytes=500)
    assert judged._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    got = {r.page_id: (r.rule, r.verdict) for r in judged.collect()}
    assert got == {i: (f"h{i}.org/p", ["allow", "block"][i % 2]) if i < 2000 else (None, "allow") for i in range(3000)}
