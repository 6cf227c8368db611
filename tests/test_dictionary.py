import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from textmart.functions import automaton, dictionary
from textmart.functions.dictionary import compile_dictionary, match_by_automaton, match_by_join, match_dictionary
from textmart.functions.text import fold_text

# canonical, alias: what the golden lines need.
TERMS = [
    ("SQL", "sql"), ("Spark", "spark"), ("Spark SQL", "spark sql"), ("Python", "python"),
    ("Azure", "azure"), ("Azure SQL", "azure sql"), ("SQL Server", "sql server"),
    ("GCP", "google cloud"), ("GCP", "gcp"), ("Cloud Storage", "cloud storage"),
    ("Git", "git"), ("GitHub", "github"), ("GitHub Actions", "github actions"),
    ("Data Integration", "data integration"), ("REST", "rest api"), ("REST", "rest"),
    ("APIs", "api"), ("REST", "rest apis"), ("Data Lake", "data lake"), ("Lakehouse", "lakehouse"),
    ("Delta Lake", "delta lake"), ("PL/SQL", "pl/sql"), ("T-SQL", "t-sql"),
    ("Power BI", "power bi"), ("Node.js", "node.js"), ("Node.js", "nodejs"), ("Node.js", "node js"),
    ("Ingles", "inglês (avançado)"), ("Ingles", "english (advanced)"),
    ("Snowflake", "snowflake"), ("Snowflake Schema", "snowflake schema"),
    ("CI/CD", "ci/cd"), ("Kubernetes", "k8s"), (".NET", ".net"), ("C++", "c++"), ("C#", "c#"),
]

GOLDEN = [
    ("Spark/SQL e python", ["Python", "Spark SQL"]),
    ("azure sql server", ["Azure SQL"]),
    ("google cloud storage", ["GCP"]),
    ("Git Hub, GitHub Actions", ["Git", "GitHub Actions"]),
    ("Data-Integration / dataintegration", ["Data Integration"]),
    ("rest apis e api", ["APIs", "REST"]),
    ("data lake house", ["Data Lake"]),
    ("delta lakehouse", ["Lakehouse"]),
    ("Python–SQL", []),
    ("PL SQL T-SQL", ["PL/SQL", "T-SQL"]),
    ("Power - BI avançado", ["Power BI"]),
    ("node.js; Node JS", ["Node.js"]),
    ("node . js", []),
    ("Inglês (Avançado), english (advanced)", ["Ingles"]),
    ("snowflake schema vs snowflake", ["Snowflake", "Snowflake Schema"]),
    ("ci/cd cicd ci-cd k8s", ["CI/CD", "Kubernetes"]),
    ("sql sql server sql", ["SQL", "SQL Server"]),
    ("asp.net .net c++ c#", [".NET", "C#", "C++"]),
    ("", []),
    (None, []),
]


def brute(text, terms):
    """Position by position, longest alias first; no shared code with the engine."""
    if not text:
        return []
    t = fold_text(text)
    order = sorted(terms, key=lambda p: -len(fold_text(p[1])))
    names = {re.sub("[ /-]+", "", fold_text(a)): c for c, a in order}
    found, i = set(), 0
    while i < len(t):
        step = 1
        if i == 0 or not t[i - 1].isalnum():
            for _, alias in order:
                words = [w for w in re.split("[ /-]+", fold_text(alias)) if w]
                j, ok = i, True
                for n, w in enumerate(words):
                    while n and j < len(t) and t[j] in " /-":
                        j += 1
                    if not t.startswith(w, j):
                        ok = False
                        break
                    j += len(w)
                if ok and words and (j == len(t) or not t[j].isalnum()):
                    found.add(names["".join(words)])
                    step = j - i
                    break
        i += step
    return sorted(found)


def random_texts(n=300):
    rng = random.Random(3)
    pieces = [w for _, a in TERMS for w in re.split("[ /-]", a)] + ["e", "x", "house", "hub"]
    seps = [" ", "-", "/", " - ", "", ".", ", ", "\n", "–"]
    return [
        "".join(rng.choice(pieces) + rng.choice(seps) for _ in range(rng.randrange(1, 14)))
        for _ in range(n)
    ]


def test_golden(rows):
    matcher = compile_dictionary(TERMS)
    assert rows([t for t, _ in GOLDEN], matcher.match) == [s for _, s in GOLDEN]


def test_pattern_equals_brute_force(rows):
    matcher, texts = compile_dictionary(TERMS), random_texts()
    assert rows(texts, matcher.match) == [brute(t, TERMS) for t in texts]


@pytest.mark.parametrize(("limit", "automaton"), [(10_000, 0), (1, 0), (1, 10**6)])
def test_all_forms_agree(spark, limit, automaton):
    texts = [t for t, _ in GOLDEN] + random_texts()
    table = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(TERMS)],
                                  "canonical STRING, alias STRING, pos INT")
    docs = spark.createDataFrame(list(enumerate(texts)), "id INT, body STRING").repartition(5)
    out = match_dictionary(docs, "id", "body", table, literal_limit=limit, automaton_limit=automaton)
    got = {r["id"]: r["skills"] for r in out.collect()}
    assert got == {i: brute(t, TERMS) for i, t in enumerate(texts)}


def test_shared_key_goes_to_the_shorter_alias(spark, rows):
    terms = [("Long", "data base"), ("Short", "database")]
    assert rows(["data base", "database", "data-base"], compile_dictionary(terms).match) == [["Short"]] * 3
    table = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(terms)],
                                  "canonical STRING, alias STRING, pos INT")
    docs = spark.createDataFrame([(1, "data base"), (2, "database")], "id INT, body STRING")
    got = match_by_join(docs, "id", "body", table).collect()
    assert {(r["id"], tuple(r["skills"])) for r in got} == {(1, ("Short",)), (2, ("Short",))}


def test_empty_dictionary(spark):
    table = spark.createDataFrame([], "canonical STRING, alias STRING, pos INT")
    docs = spark.createDataFrame([(1, "sql")], "id INT, body STRING")
    for limit, automaton in ((10, 0), (-1, -1), (-1, 10)):
        assert match_dictionary(docs, "id", "body", table, literal_limit=limit, automaton_limit=automaton).first()["skills"] == []


def test_automaton_equals_brute_force_on_random_aliases():
    rng = random.Random(9)
    letters = ["a", "b", "ab", "c+", ".n", "1"]
    for _ in range(150):
        aliases = {" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 3))) for _ in range(rng.randrange(1, 5))) for _ in range(12)}
        terms = [(f"N{i % 7}", a) for i, a in enumerate(sorted(aliases))]
        order = sorted(terms, key=lambda p: -len(p[1]))
        names = {a.replace(" ", ""): c for c, a in order}
        trie = automaton.build([(a.replace(" ", chr(automaton.JOINT)).encode(), names[a.replace(" ", "")]) for _, a in order])
        texts = ["".join(rng.choice([*letters, " ", "-", "/ ", ",", "x"]) for _ in range(rng.randrange(0, 30))) for _ in range(20)]
        got = automaton.lists(trie, pa.array([*texts, None])).to_pylist()
        assert got == [brute(t, terms) for t in texts] + [[]]


def test_many_aliases_and_a_very_long_one(spark):
    """300,000 aliases, one of them 200 words long: each is found, in a text of its own and within others."""
    long = " ".join(f"w{i}" for i in range(200))
    table = spark.range(300_000).selectExpr("concat('N', id) AS canonical", "concat('alias ', id % 1000, ' ', id) AS alias", "CAST(id AS INT) AS pos")
    table = table.unionAll(spark.createDataFrame([("Long", long, -1)], "canonical STRING, alias STRING, pos INT"))
    docs = spark.createDataFrame([(1, f"x {long} alias 7 250007."), (2, long.replace(" ", "-") + "x alias77"), (3, "alias 5 1005 / alias999 2999")], "id INT, body STRING")
    found = {r.id: r.skills for r in match_by_automaton(docs, "body", table).collect()}
    assert found == {1: ["Long", "N250007"], 2: ["N7"], 3: ["N1005", "N2999"]}


def test_a_stream_refuses_a_dictionary_beyond_its_bound(spark, tmp_path):
    table = spark.createDataFrame([("A", "alpha", 1)], "canonical STRING, alias STRING, pos INT")
    spark.createDataFrame([(1, "alpha")], "k INT, t STRING").write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema("k INT, t STRING").parquet(str(tmp_path / "feed"))
    with pytest.raises(ValueError, match="at most 3 bytes"):
        match_dictionary(stream, "k", "t", table, literal_limit=0, automaton_limit=3)


def test_a_walk_takes_memory_by_slices(monkeypatch):
    """16 MB of text in one batch; all at once they took fifty times as much."""
    trie = automaton.build([(b"spark\x01sql", "Spark SQL"), (b"spark", "Spark"), (b"c++", "C++")])
    rng = random.Random(1)
    words = ["spark", "sql", "sparksql", "c++", "sparks", "x", "-", "c"]
    texts = pa.array([None, "", *(" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(2_000))])
    whole = automaton.lists(trie, texts).to_pylist()
    monkeypatch.setattr(automaton, "SLICE", 500)
    assert automaton.lists(trie, texts).to_pylist() == whole and automaton.lists(trie, texts.slice(7, 300)).to_pylist() == whole[7:307]
    monkeypatch.undo()
    many = pa.array(["spark sql and c++ " * 1_000] * 900)
    tracemalloc.start()
    assert automaton.lists(trie, many).to_pylist() == [["C++", "Spark SQL"]] * 900
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_heads_are_found_within_texts_or_by_a_join(spark, monkeypatch):
    """The default moves no list of tokens; beyond the limit of heads the rows are the same."""
    rng = random.Random(5)
    parts = [*(a for _, a in TERMS), "x", "sparksql", "power-bi", "+", "c", "git hub", "/", ","]
    texts = [None, "", " ", *(" ".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(200))]
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)], "id INT, body STRING")
    terms = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(TERMS)], "canonical STRING, alias STRING, pos INT")
    run = lambda: match_dictionary(docs, "id", "body", terms, literal_limit=0, automaton_limit=0)
    rows = lambda df: sorted((r.id, r.body or "", r.skills) for r in df.collect())
    found, plan = rows(run()), run()._jdf.queryExecution().executedPlan().toString()
    assert "first(tokens" not in plan and any(skills for _, _, skills in found)
    whole = dictionary._matches
    monkeypatch.setattr(dictionary, "_matches", lambda *a: whole(*a, head_limit=0))
    assert "first(tokens" in run()._jdf.queryExecution().executedPlan().toString() and rows(run()) == found
    assert rows(match_dictionary(docs, "id", "body", terms)) == found
