import re

import numpy as np
import pyarrow as pa

import textmart.llm.bottomk as bottomk
from textmart.llm.common import arrow_texts, ascii_words, local_components
from textmart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({i: i + 32 for i in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    label = {i: i for i, _ in sets}
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i: (len(x), label[i], label[i] == i) for i, x in sets}


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"e{rng.integers(1e9)}"
    return out


def corpus():
    rng = np.random.default_rng(11)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, texts = fresh(60), []
    for size in (120, 200, 90):
        base = fresh(size)
        texts += [base, base] + [edited(rng, base, k) for k in rng.integers(1, 8, 40)]
    texts += [fresh(int(n)) + passage for n in rng.integers(5, 200, 60)]
    texts += [passage + edited(rng, passage, 1)[:n] for n in range(0, 20)]
    texts += [fresh(n) for n in range(1, 12)] + [["One", "two"], ["one", "TWO"], ["one"], fresh(8000)]
    docs = [(i * 7 % 1999, " ".join(t)) for i, t in enumerate(texts)]
    return docs + [(2000, None), (2001, ""), (2002, " \n"), (2003, None), (2004, "É x\x1cy a b c d"), (2005, "é x\x1cy a b c d")]


def test_components_equal_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, True, "x") for i, t in docs], "doc_id long, text string, kept boolean, component_id string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in bottomk.near_duplicates(frame).collect()}
    assert got == brute(docs)
    # Frequent values and small blocks: the other ways give the same.
    again = bottomk.near_duplicates(frame, frequent=4, block=16)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in again.collect()} == got


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "a b c d e f g h"
    frame = spark.createDataFrame([(5, text), (5, text), (3, text), (None, text), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in bottomk.near_duplicates(frame).collect())
    assert got == [(0, 3, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    assert bottomk.near_duplicates(frame.limit(0)).collect() == []


def test_words_of_slices():
    texts = pa.array(["", "Ab  c\tD ", None, " É é", "x"] * 50)
    for part in (texts, texts.slice(7, 33)):
        index, vocabulary, first = ascii_words(arrow_texts(part))
        words = vocabulary.to_pylist()
        mine = [[words[i] for i in index[a:b]] for a, b in zip(first, first[1:])]
        assert mine == [WORD.findall((t or "").translate(LOW)) for t in part.to_pylist()]


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (7, 8), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {200 + i: 100 for i in range(50)}
    assert local_components(5, np.array([3, 4]), np.array([4, 1])).tolist() == [0, 1, 2, 1, 1]


def test_an_id_with_several_texts_joins_what_they_are_linked_with(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = lambda t: t + " end"
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, c), (4, c), (5, near(c)), (None, a), (6, ""), (6, c + " more")]
    got = bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    found = sorted({(r.doc_id, r.component_id) for r in got if r.n_shingles and r.doc_id is not None})
    assert found == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4)]
    assert len(got) == len(rows) and [r.kept for r in got if r.doc_id is None] == [True]
