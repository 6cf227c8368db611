import numpy as np

from textmart.llm.severity import Severity, fit_ordinal, fit_severity, score_severity

BAD = ["loser", "scum", "moron", "vequeta", "vequemo"]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 400)))
        toxic = int(i % 5 == 0)
        for _ in range(toxic * max(2, len(text) // 30)):
            text.insert(rng.integers(len(text)), str(rng.choice(BAD)) + str(rng.choice(["", ".", "!"])))
        docs.append((seed * 100_000 + i, " ".join(text)))
        labels.append((seed * 100_000 + i, toxic))
    return docs, labels


def test_held_out_accuracy_and_order(spark):
    docs, labels = corpus(600, 1)
    model = fit_severity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(docs[0][0], None), (None, 1), (-1, 1)], "doc_id long, toxic int"))
    assert (np.diff(model.thresholds) > 0).all()
    other, truth = corpus(400, 2)
    got = {r.doc_id: r for r in score_severity(spark.createDataFrame(other, "doc_id long, text string"), model).collect()}
    right = [(got[i].p_toxic >= 0.5) == bool(t) for i, t in truth]
    assert np.mean(right) > 0.98
    for r in got.values():
        assert r.p_toxic <= r.severity <= len(model.thresholds) * r.p_toxic + 1e-9
    mean = lambda t: np.mean([got[i].severity for i, x in truth if x == t])
    assert mean(1) > 1 > mean(0)


def test_clean_words_around_a_toxic_passage_do_not_hide_it(spark):
    docs, labels = corpus(600, 1)
    model = fit_severity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    rng = np.random.default_rng(5)
    clean = lambda n: [f"w{i}" for i in rng.integers(0, 300, n)]
    passage = [w for bad in BAD * 2 for w in [*clean(5), bad]]
    texts = [clean(before) + toxic * passage + clean(n - before) for n in (0, 500, 5_000, 20_000) for before in (0, n // 3, n) for toxic in (0, 1)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.p_toxic >= 0.5 for r in score_severity(frame, model).collect()}
    assert [got[i] for i in range(len(texts))] == [False, True] * (len(texts) // 2)


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (3000, 3))
    score = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(0, 1, 3000)
    grades = np.searchsorted([-1.0, 1.5, 3.0], score)
    rows, cols = np.repeat(np.arange(3000), 3), np.tile(np.arange(3), 3000)
    weights, cuts = fit_ordinal(rows, cols, x.ravel(), grades, 3, l2=1e-6, rounds=800)
    assert np.allclose(weights, [2, -1, 0], atol=0.25) and np.allclose(cuts, [-1, 1.5, 3], atol=0.3)


def test_given_grades_are_used(spark):
    docs = [(i, f"mild{i % 2} " * 3 + "a b c") for i in range(40)] + [(40 + i, "awful worse " * 3 + "a b c") for i in range(40)] + [(80 + i, "a b c d e f") for i in range(80)]
    labels = [(i, 1 if i < 40 else 2 if i < 80 else 0) for i, _ in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = fit_severity(frame, spark.createDataFrame(labels, "doc_id long, level int"), grade="level")
    got = {r.doc_id: r.grade for r in score_severity(frame, model).collect()}
    assert got == dict(labels)


def test_defined_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x " * 40_000, "c"), (3, "x", "c"), (None, "loser", "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, grade string")
    for model in (Severity(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf])), fit_severity(frame, spark.createDataFrame([], "doc_id long, toxic int")), fit_severity(frame, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))):
        got = score_severity(frame, model).collect()
        assert len(got) == 5 and all(r.severity == 0 and r.p_toxic == 0 and r.grade == 0 for r in got)
    assert score_severity(frame.limit(0), model).collect() == []
