from datetime import datetime

from pyspark.sql import functions as F

from textmart import schemas as S
from textmart.operators import model as M

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 6, 1)
JOB = "job_id STRING, title STRING, work_mode STRING, created_at TIMESTAMP_NTZ"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_overwrites_even_with_null_and_keeps_creation(spark):
    base = spark.createDataFrame([("1", "a", "remoto", OLD), ("2", "b", None, OLD)], JOB)
    new = spark.createDataFrame([("1", None, "hibrido", NEW), ("3", "c", None, NEW)], JOB)
    once = M.upsert(base, new, "job_id", ["title", "work_mode"], ["created_at"])
    want = [("1", None, "hibrido", OLD), ("2", "b", None, OLD), ("3", "c", None, NEW)]
    assert rows(once) == sorted(want, key=repr)
    twice = M.upsert(once, new, "job_id", ["title", "work_mode"], ["created_at"])
    assert rows(twice) == rows(once)


def test_upsert_pages_stamps_the_fetch_time(spark):
    schema = "job_id STRING, html_text STRING, fetched_at TIMESTAMP"
    cache = spark.createDataFrame([("1", "old", OLD), ("2", "kept", OLD)], schema)
    new = spark.createDataFrame([("1", "new"), ("3", "first")], "job_id STRING, html_text STRING")
    got = {r["job_id"]: r for r in M.upsert_pages(cache, new).collect()}
    assert {k: r["html_text"] for k, r in got.items()} == {"1": "new", "2": "kept", "3": "first"}
    assert got["2"]["fetched_at"] == OLD and got["1"]["fetched_at"] > NEW < got["3"]["fetched_at"]


def test_latest_wins_inside_a_batch(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("1", 3, None), ("1", 2, "b"), ("2", 1, "z")],
                               "job_id STRING, seq INT, v STRING").repartition(4)
    assert rows(M.latest(df, "job_id", "seq")) == [("1", 3, None), ("2", 1, "z")]


def test_replace_children(spark):
    pair = "job_id STRING, skill STRING"
    old = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("3", "d")], pair)
    parents = spark.createDataFrame([("1",), ("2",), ("4",)], "job_id STRING")
    new = spark.createDataFrame([("1", "b"), ("1", "b"), ("1", "x"), ("4", "n"), ("9", "orphan")], pair)
    out = M.replace_children(old, parents, new, "job_id", "skill")
    # Parent 2 comes without children and loses its old one; 9 is no incoming parent.
    assert rows(out) == [("1", "b"), ("1", "x"), ("3", "d"), ("4", "n")]


def test_insert_ignore_and_cascade(spark):
    pair = "job_id STRING, skill STRING"
    base = spark.createDataFrame([("1", "a")], pair)
    new = spark.createDataFrame([("1", "a"), ("1", "b"), ("1", "b")], pair)
    assert rows(M.insert_ignore(base, new, ["job_id", "skill"])) == [("1", "a"), ("1", "b")]
    gone = spark.createDataFrame([("1",), ("1",)], "job_id STRING")
    kept = M.cascade_delete(spark.createDataFrame([("1", "a"), ("2", "b")], pair), gone, "job_id")
    assert rows(kept) == [("2", "b")]


def test_shapes(spark):
    entries = spark.createDataFrame(
        [("1", "t", ["a", "b"]), ("2", None, [])], "job_id STRING, title STRING, skills ARRAY<STRING>"
    )
    parents, children = M.normalize(entries)
    assert rows(parents) == [("1", "t"), ("2", None)]
    assert rows(children) == [("1", "a"), ("1", "b")]
    fixed = M.project(entries, S.JOBS_CSV)
    assert fixed.columns == S.JOB_COLUMNS and rows(fixed)[0] == ("1", "t", None, None, None)
    assert rows(M.append(parents, parents.select("job_id"))) == [
        ("1", "t"), ("1", None), ("2", None), ("2", None)]


def test_children_by_parent_keeps_duplicates(spark):
    parents = spark.createDataFrame([("1",), ("2",)], "job_id STRING")
    children = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "b"), ("9", "z")], "job_id STRING, skill STRING")
    out = M.children_by_parent(parents, children, "job_id", "skill", "skills")
    assert rows(out) == [("1", ["a", "b", "b"]), ("2", [])]


def test_checks(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", None), (None, "b")], "k STRING, v STRING")
    assert rows(M.key_violations(df, ["k", "v"])) == [("1", "a", 2)]
    assert rows(M.domain_violations(df, "v", ["a"])) == [(None, "b")]
    assert rows(M.null_violations(df, ["k", "v"])) == [("2", None, ["v"]), (None, "b", ["k"])]
    parents = spark.createDataFrame([("1",)], "k STRING")
    assert rows(M.orphans(df.where(F.col("k").isNotNull()), parents, "k")) == [("2", None)]
