from collections import defaultdict

import pytest

from textmart.llm.mixing import filled, mix


def water(budget, children):
    """name -> share of (weight, capacity)."""
    full, share = set(), {}
    while True:
        rest = budget - sum(children[c][1] for c in full)
        weights = sum(w for c, (w, _) in children.items() if c not in full)
        share = {c: children[c][1] if c in full else (max(rest, 0) * w / weights if weights > 0 else 0) for c, (w, _) in children.items()}
        new = {c for c in children if c not in full and share[c] >= children[c][1]}
        if not new:
            return share
        full |= new


def corpus():
    docs = []
    for i in range(900):
        domain = "web" if i % 3 else "books"
        lang = ["en", "de", None][i % 7 % 3]
        docs.append((i, "word " * (1 + i * 37 % 50), domain, lang, f"src{0 if i % 2 else i % 5}", "old"))
    return docs + [(900, None, "web", "en", "src0", ""), (901, "", None, None, None, ""), (902, "x " * 3000, "tiny", "en", "only", "")]


SCHEMA = "doc_id long, text string, domain string, lang string, source string, epochs string"


def brute_budgets(docs, budget, weights, max_epochs):
    leaves = defaultdict(int)
    for _, text, *path, _ in docs:
        leaves[tuple(path)] += len((text or "").split())
    leaves = {k: v for k, v in leaves.items() if v}

    def weight(prefix):
        level = ("domain", "lang", "source")[len(prefix) - 1]
        if level in weights:
            return max(0.0, weights[level].get(prefix[-1], 1.0))
        return sum(v for k, v in leaves.items() if k[: len(prefix)] == prefix) ** 0.5

    def capacity(prefix):
        if prefix and weight(prefix) <= 0:
            return 0
        if len(prefix) == 3:
            return leaves[prefix] * max_epochs
        return sum(capacity(c) for c in {k[: len(prefix) + 1] for k in leaves if k[: len(prefix)] == prefix})

    out = {}

    def share(prefix, amount):
        if len(prefix) == 3:
            out[prefix] = amount
            return
        below = {k[: len(prefix) + 1] for k in leaves if k[: len(prefix)] == prefix}
        for child, part in water(amount, {c: (weight(c), capacity(c)) for c in below}).items():
            share(child, part)

    share((), min(budget, capacity(())))
    return leaves, out


@pytest.mark.parametrize("budget", [10, 2_000, 12_000, 60_000, 10**7])
def test_budgets_and_prefixes(spark, budget):
    docs = corpus()
    weights = {"lang": {"en": 0.7, "de": 0.3, None: 0.5}, "domain": {"web": 3.0, "books": 1.0, "tiny": 1.0}}
    frames = {k: spark.createDataFrame([(v, w) for v, w in t.items()], f"{k} string, weight double") for k, t in weights.items()}
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    rows = mix(frame, budget, weights=frames, max_epochs=3).collect()
    leaves, want = brute_budgets(docs, budget, weights, 3)
    taken, counts = defaultdict(int), defaultdict(list)
    for r in rows:
        assert 1 <= r.epochs <= 3 and 0 < r.take_tokens <= r.epochs * r.n_tokens
        taken[r.domain, r.lang, r.source] += r.take_tokens
        counts[r.domain, r.lang, r.source].append((r.epochs, r.take_tokens, r.n_tokens))
    for leaf, amount in want.items():
        assert abs(taken[leaf] - amount) <= 1, leaf
        whole = int(amount + 1e-6) // leaves[leaf]
        assert all(e in (whole, whole + 1) for e, _, _ in counts[leaf])
        # Of the unfinished epoch one text at most counts in part.
        assert sum(t != e * n for e, t, n in counts[leaf]) <= 1


def test_seeds_and_least_epochs(spark):
    frame = spark.createDataFrame(corpus(), SCHEMA)
    total = sum(len((t or "").split()) for _, t, *_ in corpus())
    pick = lambda **k: {(r.doc_id, r.epochs) for r in mix(frame, None, share=0.5, **k).collect()}
    assert pick(seed=1) == pick(seed=1) != pick(seed=2)
    rows = mix(frame, None, share=1.3, least_epochs=1).collect()
    assert len(rows) == 901  # every text with tokens
    assert abs(sum(r.take_tokens for r in rows) - 1.3 * total) <= 30


def test_shortages_go_to_siblings_first(spark):
    children = spark.createDataFrame([("a1", "a", 1.0, 5.0), ("a2", "a", 1.0, 100.0), ("b1", "b", 0.0, 0.0), ("b2", "b", 2.0, 50.0)], "node string, parent string, weight double, capacity double")
    budgets = spark.createDataFrame([("a", 60.0), ("b", 50.0)], "parent string, budget double")
    assert {r.node: r.budget for r in filled(children, budgets).collect()} == {"a1": 5.0, "a2": 55.0, "b1": 0.0, "b2": 50.0}


def test_empty_and_repeated_rows(spark):
    frame = spark.createDataFrame(corpus(), SCHEMA)
    assert mix(frame.limit(0), None).collect() == []
    assert mix(frame.where("doc_id in (900, 901)"), None).collect() == []
    same = spark.createDataFrame([(1, "a b c", "d", "e", "f", "")] * 3, SCHEMA)
    assert len(mix(same, 4).collect()) == 3


def test_columns_with_the_names_of_its_own_tables(spark):
    rows = [(i, "a b c", "en", f"s{i % 3}", i, i, i, i, i, i, i) for i in range(30)]
    names = "part long, node long, whole long, rest long, cut long, _hash long, _node long"
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {names}")
    clash = mix(docs, 40.0, levels=("lang", "source"))
    plain = mix(docs.select("doc_id", "text", "lang", "source"), 40.0, levels=("lang", "source"))
    key = ["doc_id", "n_tokens", "epochs", "take_tokens"]
    assert sorted(map(tuple, clash.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
    assert all(r.part == r.cut == r._node == r.doc_id for r in clash.collect())
