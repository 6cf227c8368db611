"""Shares, distances and best terms against a plain count."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textmart.llm import divergence

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, term STRING, n LONG"


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = {t for t, d in docs[lang].items() if d >= min_docs}
        whole = Counter()
        for other in groups:
            if other[0] == lang:
                whole.update({t: c for t, c in counts[other].items() if t in kept})

        def p(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        mine, parts = p(counts[lang, source]), {}
        parts["pair"] = [(o, sum(abs(mine[t] - q) for t, q in p(counts[lang, o]).items())) for k, o in groups if k == lang and o != source]
        q = p(whole)
        parts["term"] = [(t, mine[t] - q[t]) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, items in parts.items():
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [(lang, source, part, item, value, r) for r, (item, value) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


def documents(n, seed=3):
    rnd = random.Random(seed)
    words = ["The", "the", "É", "é", "straße", "x1y", "a-b", "日本", "zz", "own0", "Own1", "own2"]
    rows = []
    for i in range(n):
        source = rnd.choice(["s0", "s0", "s0", "s1", "s2", "s3", None])
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30)))
        rows.append((i // 2, rnd.choice([text, text, text, None, "", "12 34\x00;"]), rnd.choice(["en", "en", "de", None]), source, "clash", 7))
    rows.append((1, "solitary", "fr", "s9", None, None))
    return rows


@pytest.mark.parametrize(("tile", "shard_rows", "top"), [(512, 200_000, 50), (2, 5, 3), (1, 1000, 1)])
def test_equals_a_plain_count(spark, tile, shard_rows, top):
    rows = documents(120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = divergence.source_divergence(df, min_docs=4, top=top, tile=tile, shard_rows=shard_rows)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, top)


def test_no_kept_term_and_no_rows(spark):
    rows = documents(20)
    df = spark.createDataFrame(rows, SCHEMA)
    got = divergence.source_divergence(df, min_docs=1000).collect()
    assert got and {r.value for r in got} == {0} and {r.part for r in got} == {"pair"}
    assert divergence.source_divergence(df.limit(0)).collect() == []


def test_shares_are_exact():
    counts = [0, 1, 10**6, 9 * 10**15 - 10**10]
    total, v = 9 * 10**15, 10**9 // 3
    want = [1 + 10**9 * (c + 5) // (total + 5 * v) for c in counts]
    assert divergence.shares(np.array(counts), total, v).tolist() == want


def test_tasks_hand_on_many_counts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 3)
    batches = [pa.record_batch({"text": ["a b c", None], "lang": ["en", "en"], "source": ["s", "t"]}), pa.record_batch({"text": ["a d"], "lang": ["en"], "source": ["s"]})]
    out = pa.Table.from_batches(list(divergence.count_terms(iter(batches))))
    total = Counter()
    for row in out.to_pylist():
        total[row["term"]] += row["n"]
    assert total == Counter("abcad")
