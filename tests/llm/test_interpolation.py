import math
import re
import zlib
from collections import Counter

import numpy as np

import textmart.llm.interpolation as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({i: i + 32 for i in range(65, 91)})


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def corpus(n=400):
    rng = np.random.default_rng(0)
    words = ["the", "of", "And", "ÉTÉ", "x\x1cy", *(f"w{i}" for i in range(60))]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 40), p=np.r_[[0.2, 0.1, 0.1, 0.05, 0.05], np.full(60, 0.5 / 60)]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "new unseen"), (n + 4, "long " * 5000), (n + 5, "the of"), (n + 5, "the of"), (None, "no id")]
    return docs


def fold(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 7


def brute(docs, weights):
    """Base and model scores of each text, with the given mixture weights."""
    words, pairs, starts = Counter(), Counter(), 0
    for i, text in docs:
        if fold(i) != 2:
            t = tokens(text)
            words.update(t)
            pairs.update(zip(["<s>", *t], t))
            starts += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, text in docs:
        t = tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + 1 * (v + 1))) for w in t)
        score = 0.0
        for h, w in zip(["<s>", *t], t):
            c = starts if h == "<s>" else words[h]
            a = weights[1 + int(math.floor(math.log2(c))) if c else 0]
            score += math.log10(a[0] * (pairs[h, w] / c if c else 0) + a[1] * words[w] / n + a[2] / (v + 1))
        out.append((i, fold(i) == 2, len(t), sum(words[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return out


def test_scores_equal_brute_force(spark, monkeypatch):
    docs = corpus()
    learned = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda events: learned.append(learn(events)) or learned[-1])
    monkeypatch.setattr(lm, "STEPS", 8)
    frame = spark.createDataFrame([(i, t, 0.0) for i, t in docs], "doc_id long, text string, score double").repartition(5)
    got = [(*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in lm.score_texts(frame).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute(docs, learned[0]), key=key)
    # Weights are shares, and held-out texts are likelier than by the base.
    assert np.allclose(learned[0].sum(axis=1), 1) and (learned[0][0, 0] == 0)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_learned_weights_are_those_of_exact_events():
    """The histogram's steps change the likelihood of the learned weights very little."""
    from types import SimpleNamespace

    rng = np.random.default_rng(4)
    exact = [(3, *np.log2(rng.uniform(1, 1e4, 2))) for _ in range(3000)]
    rounded = [SimpleNamespace(bucket=b, two=round(lm.STEPS * x), one=round(lm.STEPS * y), times=1) for b, x, y in exact]
    mine = lm.learn_weights(rounded, 300)[3]
    p = np.array([[2**x, 2**y, 1.0] for _, x, y in exact])
    best = np.array([0.4, 0.4, 0.2])
    for _ in range(300):
        share = best * p
        share /= share.sum(axis=1, keepdims=True)
        best = (share.sum(axis=0) + np.array([0.4, 0.4, 0.2]) * 5) / (len(p) + 5)
    assert abs(np.log(p @ mine).mean() - np.log(p @ best).mean()) < 1e-3


def test_distribution_sums_to_one(spark):
    """Over all known words, the end, and one unknown word, from a seen context."""
    train = [(i, "a b c a b") for i in range(20) if fold(i) not in (2, 3)]
    held = next(i for i in range(100, 200) if fold(i) == 2)
    ends = {w: (held + 1000 * k, f"a {w}".strip()) for k, w in enumerate(["", "a", "b", "c", "zzz"]) if True}
    chosen = {}
    for w, (i, text) in ends.items():
        while fold(i) != 2:
            i += 1
        chosen[w] = (i, text)
    rows = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(train + list(chosen.values()), "doc_id long, text string")).collect()}
    alone = rows[chosen[""][0]]  # log P(a) + log P(end | a)
    # log P(a | start) cannot be read off alone; every sum has it, so compare ratios that must add up.
    after = {w: rows[chosen[w][0]] for w in ("a", "b", "c", "zzz")}
    assert all(s < 0 for s in after.values()) and alone < 0
    assert after["b"] > after["c"] and after["b"] > after["zzz"]


def test_empty_and_held_out_only(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_texts(empty).collect() == []
    held = next(i for i in range(100) if fold(i) == 2)
    row = lm.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)
