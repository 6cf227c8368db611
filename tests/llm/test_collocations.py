"""Automata against dictionaries, phrases against a plain count."""

import bisect
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from textmart.llm import automata, collocations

SCHEMA = "doc_id LONG, text STRING, lang STRING, phrase STRING, a LONG"


def brute(rows, least, top):
    counts, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    frequent = {p: a for p, a in counts.items() if a >= least}
    out = []
    for lang in total:
        scored = []
        for p, a in frequent.items():
            if p[0] != lang or len(p) < 3:
                continue
            cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[(lang, *p[k:])]), k - 1, counts[p[:k]], counts[(lang, *p[k:])]) for k in range(2, len(p))]
            text = " ".join(p[1:])
            if not any(q[0] == lang and len(q) > len(p) and b >= a and f" {text} " in f" {' '.join(q[1:])} " for q, b in frequent.items()):
                scored.append((text, a, *min(cuts)))
        scored.sort(key=lambda x: (-x[2], -x[1], x[0].encode()))
        out += [(lang, r, text, a, left, right, total[lang], score) for r, (text, a, score, _, left, right) in enumerate(scored[:top], 1)]
    return sorted(out)


def documents(n, seed=5):
    rnd = random.Random(seed)
    words = ["The", "new", "york", "new", "city", "é", "日本", "in", "in", "x\x0b", "a-b"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", " ", ", ", ".\n"]) for _ in range(rnd.randrange(0, 40)))
        if rnd.random() < 0.5:
            text += "one fixed phrase stands here always" + rnd.choice(["", "!", " in"])
        rows.append((i // 2, rnd.choice([text, text, text, None, "", " \t "]), rnd.choice(["en", "en", "en", "de", None]), "clash", 1))
    return rows


@pytest.mark.parametrize(("range_bytes", "least", "top", "fan"), [(16 << 20, 8, 2000, 256), (200, 8, 2000, 256), (100, 5, 7, 3), (1 << 20, 10**6, 9, 256)])
def test_equals_a_plain_count(spark, monkeypatch, range_bytes, least, top, fan):
    monkeypatch.setattr(collocations, "FAN", fan)
    monkeypatch.setattr(collocations, "LOOKUPS", 50)
    rows = documents(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = collocations.phrases(df, least=least, top=top, range_bytes=range_bytes, filter_bits=15)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, top)
    assert sorted(map(tuple, got.collect())) == want
    assert (least > 1000) == (not want)


def test_a_crowded_filter_only_costs_work(spark):
    rows = documents(200, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    # 32,768 places with every bit of them set: all phrases pass.
    assert sorted(map(tuple, collocations.phrases(df, least=1, top=10**6, filter_bits=15).collect())) == brute(rows, 1, 10**6)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert collocations.phrases(df).collect() == []


def random_counts(rnd, n):
    return Counter(tuple([rnd.choice(["x", "y"]), *[rnd.choice("abcdé") for _ in range(rnd.randrange(1, 6))]]) for _ in range(n))


def automaton(counts):
    """One automaton a phrase, united."""
    parts = []
    for (lang, *words), n in counts.items():
        table, at = automata.sorted_words(pa.array(words, pa.large_string()))
        zeros = [pa.array([0]).to_numpy()] * len(words)
        parts.append(automata.Automaton([lang], table, zeros, [at[i : i + 1] for i in range(len(words))], [pa.array([n if i == len(words) - 1 else 0]).to_numpy() for i in range(len(words))]))
    return automata.union(parts)


def content(a):
    return Counter({(lang, *words): n for lang, words, n in automata.phrases_of(a)})


def test_union_cut_prune_and_composition():
    rnd = random.Random(1)
    for _ in range(60):
        one, two = random_counts(rnd, 50), random_counts(rnd, 50)
        both = automata.union([automaton(one), automaton(two)])
        assert content(both) == one + two
        assert content(automata.loads(automata.dumps(both))) == one + two
        assert content(automata.pruned(both, 3)) == Counter({p: n for p, n in (one + two).items() if n >= 3})
        bounds = sorted({p[: rnd.randrange(2, 7)] for p in random_counts(rnd, rnd.randrange(0, 9))} | {("x", "bz"), ("xx", "a")})
        seen = Counter()
        for r, part in automata.cut(both, bounds):
            assert all(bisect.bisect_right(bounds, p) == r for p in content(part))
            seen += content(part)
        assert seen == one + two
        asked = [*(one + two), *random_counts(rnd, 20), ("z", "a"), ("x", "unknown"), ("x", "a", "unknown", "b")]
        assert automata.weights_of(both, asked).tolist() == [(one + two)[p] for p in asked]


def test_words_and_pieces():
    texts = ["A b,c", "", ".", "d  \te.F", "\xc9\xa0x! y"]
    words, text, left = collocations.split_words(pa.array(texts, pa.large_string()))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "f", "\xc9\xa0x", "y"]
    assert text.tolist() == [0, 0, 0, 3, 3, 3, 4, 4]
    assert left.tolist() == [2, 1, 1, 2, 1, 1, 1, 1]
