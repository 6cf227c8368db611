import random

from pyspark.sql import functions as F

from textmart.operators import incremental as I
from textmart.plans.collect import collect_ids


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_collect(pages, stored):
    """The sequential rule: per term in order, stop at the first page without ids."""
    seen, out = set(), []
    for term in sorted({t for t, *_ in pages}):
        for _, page, url, ids in sorted(p for p in pages if p[0] == term):
            if not ids:
                break
            new = [i for i in ids if i not in seen and i not in stored]
            out += [(i, url) for i in new]
            seen.update(new)
    return sorted(out)


def markup(ids):
    return "<p>" + "".join(f'<li data-entity-urn="urn:li:jobPosting:{i}">' for i in ids)


def make_pages(seed):
    rng = random.Random(seed)
    return [
        (term, page, f"u{term}-{page}", [str(rng.randrange(25)) for _ in range(rng.randrange(0, 6))])
        for term in range(6)
        for page in range(5)
    ]


def test_collect_equals_the_sequential_rule(spark):
    for seed in range(3):
        pages, stored = make_pages(seed), {"3", "4"}
        df = spark.createDataFrame(
            [(t, p, u, markup(ids)) for t, p, u, ids in pages],
            "term_ord INT, page INT, url STRING, html STRING",
        ).repartition(7)
        known = spark.createDataFrame([(i,) for i in stored], "job_id STRING")
        assert rows(collect_ids(df, known)) == brute_collect(pages, stored)


def test_first_seen_keeps_copies_of_its_first_page(spark):
    data = [(1, ["a", "b", "a"]), (2, ["a", "c", "c", "c"]), (3, ["c", "d"]), (4, [])]
    for parts in (1, 5):
        df = spark.createDataFrame(data, "page INT, ids ARRAY<STRING>").repartition(parts)
        assert rows(I.first_seen(df, "ids", "page")) == [
            ("a", 1), ("a", 1), ("b", 1), ("c", 2), ("c", 2), ("c", 2), ("d", 3)]
        assert rows(I.first_seen_strict(df, "ids", "page")) == [("a", 1), ("b", 1), ("c", 2), ("d", 3)]


def test_take_while(spark):
    df = spark.createDataFrame(
        [("x", 1, 2), ("x", 2, 0), ("x", 3, 5), ("y", 1, 1), ("y", 2, 1), ("z", 1, 0)], "t STRING, p INT, n INT"
    )
    assert rows(I.take_while(df, "t", "p", F.col("n") > 0)) == [("x", 1, 2), ("y", 1, 1), ("y", 2, 1)]


def test_worklist(spark):
    ids = spark.createDataFrame([("1",), ("2",), ("2",), ("3",), ("4",)], "id STRING")
    done = spark.createDataFrame([("1",), ("4",)], "id STRING")
    have = spark.createDataFrame([("1",), ("2",), ("2",)], "id STRING")
    fetch = I.worklist_status(ids, done, have, "id", True)
    assert rows(fetch) == [("1", "processed"), ("2", "cached"), ("3", "to-fetch"), ("4", "processed")]
    assert ("3", "no-html") in rows(I.worklist_status(ids, done, have, "id", False))


def test_anti_joins(spark):
    left = spark.createDataFrame([("1",), ("2",), ("2",)], "id STRING")
    right = spark.createDataFrame([("1",), ("1",), ("7",)], "id STRING")
    assert rows(I.not_in(left, right, "id")) == [("2",), ("2",)]
    assert rows(I.not_in_store(left, right, "id")) == [("2",), ("2",)]
    assert rows(I.in_cache(left, right, "id")) == [("1",)]
    assert rows(I.difference(left, right)) == [("2",)]


def test_frontier(spark):
    terms = spark.createDataFrame([(0, "a-b"), (1, "c")], "term_ord INT, term STRING")
    template = "http://x/%s?start=%d"
    out = I.url_frontier(terms, template, 2, 10, ["term_ord"])
    assert [r["url"] for r in out.orderBy("term_ord", "page").collect()] == [
        "http://x/a-b?start=0", "http://x/a-b?start=10", "http://x/c?start=0", "http://x/c?start=10"]
    assert I.url_frontier(terms, template, 0, 10, ["term_ord"]).count() == 0


def test_nonblank(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x STRING")
    assert rows(I.nonblank(df, "x")) == [("a",)]
