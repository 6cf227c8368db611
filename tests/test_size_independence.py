"""What must not depend on the size of a table, on repeated or missing keys, or on a restart."""

import re

import pytest
from pyspark.sql import functions as F

from textmart import sources
from textmart.functions import classify as C
from textmart.functions.dictionary import compile_dictionary, match_by_join, match_dictionary
from textmart.functions.text import fold_text, transliterate
from textmart.operators import model as M
from textmart.plans import extract
from textmart.plans.collect import collect_ids
from textmart.streaming import upserts as SU


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TERMS = [("Python", "python"), ("SQL", "sql"), ("Spark SQL", "spark sql"), ("C++", "c++"), ("A B C", "a b c"), ("CI", "c/i-x"), (None, "x"), ("y", None)]


def terms(spark):
    return spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(TERMS)], "canonical STRING, alias STRING, pos INT")


def test_dictionary_forms_on_repeated_and_null_keys(spark):
    texts = ["python", "spark sql x sql", None, "", "SparkSQL", "ab c", "a bc", "abc", "c++/python", "ci x cix", "pythonic", "spark", "python", "Spark  Sql"]
    data = [(None if i % 4 == 3 else i % 2, i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "k INT, i INT, t STRING")
    literal = match_dictionary(docs, "k", "t", terms(spark))
    joined = match_dictionary(docs, "k", "t", terms(spark), literal_limit=0, automaton_limit=0)
    walked = match_dictionary(docs, "k", "t", terms(spark), literal_limit=0)
    assert literal.columns == joined.columns == walked.columns
    assert rows(literal) == rows(joined) == rows(walked)
    found = {r.i: list(r.skills) for r in joined.collect()}
    assert found[1] == ["SQL", "Spark SQL"] and found[2] == [] and found[0] == found[12] == ["Python"]
    assert len(match_by_join(docs, "i", "t", terms(spark)).collect()) == sum(bool(v) for v in found.values())


def test_a_stream_takes_a_dictionary_of_any_size(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    spark.createDataFrame([(1, "python")], "k INT, t STRING").write.parquet(feed)
    stream = match_dictionary(spark.readStream.schema("k INT, t STRING").parquet(feed), "k", "t", terms(spark), literal_limit=0)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.skills for r in spark.read.parquet(out).collect()] == [["Python"]]


@pytest.mark.parametrize("empty", [False, True])
def test_rule_forms_on_ties_and_empty_keywords(spark, empty):
    rules = [(1, "ab", "Z"), (1, "b", "M"), (2, "c", "A"), (0, None, "none"), (5, "longer keyword than sixteen letters", "L")]
    rules += [(3, "", "E")] * empty
    table = spark.createDataFrame(rules, "priority INT, keyword STRING, label STRING")
    titles = ["xabx", "b", "c", "", None, "q", "a longer keyword than sixteen letters", "xabx"]
    df = spark.createDataFrame(list(enumerate(titles)), "i INT, t STRING")
    both = [rows(C.classify_by_rules(df, "t", table, "o", "dflt", limit=n)) for n in (100, 0)]
    assert both[0] == both[1]
    got = {r[0]: r[2] for r in both[0]}
    assert (got[0], got[1], got[2], got[4], got[5]) == ("M", "M", "A", "dflt", "E" if empty else "dflt")


def test_pages_without_an_id_stay_pending_at_any_size(spark):
    cache = spark.createDataFrame([("1", "a"), (None, "b"), ("2", "c")], "job_id STRING, html_text STRING")
    jobs = spark.createDataFrame([("1",)], "job_id STRING")
    small, large = (rows(extract.unprocessed_pages(cache, jobs, small=n)) for n in (10, 0))
    assert small == large == [("2", "c"), (None, "b")]


def test_sinks_refuse_or_resolve_repeated_ids(spark, tmp_path):
    schema = "job_id STRING, title STRING, seq INT"
    base = spark.createDataFrame([("1", "old")], "job_id STRING, title STRING").withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    skills = spark.createDataFrame([("1", "x")], "job_id STRING, skill STRING")
    batch = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 1), ("2", "d", 3)], schema)
    write = lambda name, **k: sources.write_model(batch, skills, "database", str(tmp_path / name), current=(base, skills), columns=["title"], **k)
    with pytest.raises(ValueError, match="repeats"):
        write("refused")
    write("resolved", seq="seq")
    assert rows(spark.read.parquet(str(tmp_path / "resolved/jobs")).select("job_id", "title")) == [("1", "b"), ("2", "d")]
    cache = spark.createDataFrame([("1", "p", None)], "job_id STRING, html_text STRING, fetched_at TIMESTAMP")
    pages = spark.createDataFrame([("1", "q", 1), ("1", "r", 2)], "job_id STRING, html_text STRING, n INT")
    with pytest.raises(ValueError):
        M.upsert_pages(cache, pages)
    assert [r.html_text for r in M.upsert_pages(cache, pages, seq="n").collect()] == ["r"]


def test_entries_are_extracted_once(spark, tmp_path):
    html = "<html><head><title>T</title></head><body><h1>Python dev</h1></body></html>"
    path = str(tmp_path / "pages")
    spark.createDataFrame([("1", html), ("2", html)], "job_id STRING, html_text STRING").write.parquet(path)
    parents, children = extract.staged(extract.build_entries(spark.read.parquet(path), terms(spark)))
    for df in (parents, children):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "html_text" not in plan and not re.search("Python|Arrow", plan)
    assert parents.count() == 2


def test_collect_ids_on_a_repeated_page(spark):
    page = (1, 0, "u", 'href="/jobs/view/111222333"')
    df = spark.createDataFrame([page, page, (1, 1, "v", page[3])], "term_ord INT, page INT, url STRING, html STRING")
    stored = spark.createDataFrame([], "job_id STRING")
    assert rows(collect_ids(df, stored, r"view/(\d+)")) == [("111222333", "u")]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    file = tmp_path / "ids.csv"
    file.write_text("url,other,job_id\nhttp://a,x,1\nhttp://b,y,\n")
    assert rows(sources.read_job_ids_csv(spark, str(file))) == [("1", "http://a")]
    (tmp_path / "d.csv").write_text("pos,alias,canonical\n3,py,Python\n")
    assert rows(sources.read_dictionary(spark, str(tmp_path / "d.csv"))) == [("Python", "py", 3)]


def test_cache_order_is_that_of_the_appends(spark, tmp_path):
    path, schema = str(tmp_path / "html"), "job_id STRING, html_text STRING"
    for i in range(3):
        batch = spark.createDataFrame([(str(k), f"v{i}") for k in range(20)], schema)
        sources.write_html_csv(batch.repartition(6), path, batch=i)
    assert {r.html_text for r in sources.read_html_cache_csv(spark, path).collect()} == {"v2"}


def test_hash_conditions_cover_every_row():
    conditions = sources.read.hash_conditions("h", 4)
    assert len(conditions) == 4 and "IS NULL" in conditions[0]
    for h in (-7, -4, 0, 3, 10):
        assert sum(abs(int(__import__("math").fmod(h, 4))) == i for i in range(4)) == 1


def test_reading_upserts_sorts_no_snapshot(spark, tmp_path):
    schema = "job_id STRING, seq INT, title STRING"
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")
    for i, batch in enumerate([[("1", 1, "a"), ("2", 1, "b")], [("2", 2, "c"), ("3", 1, "d")]]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(feed)
        SU.stream_upsert(spark.readStream.schema(schema).parquet(feed), "job_id", "seq", store, str(tmp_path / "c"))
        if not i:
            SU.compact(spark, store, "job_id")
    now = SU.current(spark, store, "job_id")
    assert rows(now.select("job_id", "seq", "title")) == [("1", 1, "a"), ("2", 2, "c"), ("3", 1, "d")]
    assert "SortAggregate" not in now._jdf.queryExecution().executedPlan().toString()


def test_one_parent_with_most_children(spark):
    parents = spark.createDataFrame([("a",), ("b",), ("c",)], "p STRING")
    children = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("p"), (F.col("id") % 50).alias("i"))
    counted = M.child_counts(parents, children, "p", "i")
    got = rows(counted.groupBy("p").agg(F.count("i"), F.sum("n")))
    assert got == [("a", 50, 2000), ("b", 50, 1000), ("c", 0, 0)]


def test_driver_fold_and_other_scripts(rows):
    values = ["É–x", " a\t\tb ", "ﬁn ½", "\x1cz", "A  B", ""]
    from textmart.functions.text import fold

    assert rows(values, fold) == [fold_text(v) for v in values]
    assert rows(["Привет, Ёж", "Αθήνα Ψ"], transliterate) == ["Privet, Iozh", "Athena Ps"]


def test_compiled_dictionary_is_unchanged_by_the_fold():
    assert compile_dictionary([("É", "é")]).canonical_by_key == {"e": "É"}
