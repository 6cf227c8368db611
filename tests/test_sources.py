import pytest
from pyspark.sql import functions as F

from textmart import sources
from textmart.operators.model import normalize, null_violations
from textmart.plans import analyse, extract


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ids_csv(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert rows(sources.read_job_ids_csv(spark, path)) == []
    df = spark.createDataFrame([("1", "u,1"), ("", "x"), (None, "y")], "job_id STRING, url STRING")
    sources.append_ids_csv(df, path)
    sources.append_ids_csv(spark.createDataFrame([("007", "u")], df.schema), path)
    assert rows(sources.read_job_ids_csv(spark, path)) == [("007", "u"), ("1", "u,1")]


def test_html_cache_last_row_wins(spark, tmp_path):
    path = str(tmp_path / "html")
    assert rows(sources.read_html_cache_csv(spark, path)) == []
    schema = "job_id STRING, html_text STRING"
    for batch in ([("1", 'a "q"\r\n\nb,c'), (" 2 ", "old")], [("2", "new\\"), (" ", "x"), ("3", "")]):
        sources.write_html_csv(spark.createDataFrame(batch, schema).coalesce(1), path)
    want = [("1", 'a "q" b,c'), ("2", "new\\"), ("3", "")]
    assert rows(sources.read_html_cache_csv(spark, path)) == want


def test_html_cache_of_one_file_keeps_file_order(spark, tmp_path):
    file = tmp_path / "cache.csv"
    lines = [f'"{i % 5}","v{i}"' for i in range(200)]
    file.write_text("job_id,html_text\n" + "\n".join(lines) + "\n")
    assert rows(sources.read_html_cache_csv(spark, str(file))) == [(str(k), f"v{195 + k}") for k in range(5)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        split = sources.read_html_cache_csv(spark, str(file))
        assert rows(split) == [(str(k), f"v{195 + k}") for k in range(5)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_multi_line_cache(spark, tmp_path):
    file = tmp_path / "cache.csv"
    file.write_text('job_id,html_text\n"1","a\nb ""x"""\n')
    assert rows(sources.read_html_cache_csv(spark, str(file), multi_line=True)) == [("1", 'a\nb "x"')]


@pytest.mark.parametrize("content", [None, "", "  ", "[{broken", "[]", "not json"])
def test_tolerant_json(spark, tmp_path, content):
    file = tmp_path / "entries.json"
    if content is not None:
        file.write_text(content)
    assert rows(sources.read_entries_json(spark, str(file))) == []


def test_json_array_and_lines(spark, tmp_path):
    file = tmp_path / "entries.json"
    file.write_text('[\n {"job_id": "1", "title": "t", "work_mode": null, "skills": ["a", "b"]},\n {"job_id": "2"}\n]')
    entries = sources.read_entries_json(spark, str(file))
    want = [("1", "t", None, None, None, ["a", "b"]), ("2", None, None, None, None, None)]
    assert rows(entries) == want
    sources.write_entries_json(entries, str(tmp_path / "out"))
    sources.write_entries_json(entries, str(tmp_path / "out"))
    assert rows(sources.read_entries_json_lines(spark, str(tmp_path / "out"))) == want


def model(spark):
    jobs = spark.createDataFrame([("1", "t", None), ("2", "São Paulo, SP", "remoto")], "job_id STRING, title STRING, work_mode STRING")
    skills = spark.createDataFrame([("1", "a"), ("1", "b"), ("9", "orphan")], "job_id STRING, skill STRING")
    return jobs, skills


def test_the_two_sinks_differ_on_orphans(spark, tmp_path):
    jobs, skills = model(spark)
    columns = ["title", "work_mode"]
    sources.write_model(jobs, skills, "local", str(tmp_path / "l"), columns=columns)
    read = spark.read.option("header", True).csv(str(tmp_path / "l" / "job_skills"))
    assert rows(read) == [("1", "a"), ("1", "b"), ("9", "orphan")]
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "l" / "jobs"))) == rows(jobs)

    now = F.lit("2024-01-01").cast("timestamp")
    base = jobs.where("job_id = '2'").withColumn("created_at", now)
    old = spark.createDataFrame([("2", "gone"), ("5", "kept")], "job_id STRING, skill STRING")
    batch = jobs.withColumn("created_at", now)
    sources.write_model(batch, skills, "database", str(tmp_path / "d"), (base, old), columns)
    read = spark.read.parquet(str(tmp_path / "d" / "job_skills"))
    assert rows(read) == [("1", "a"), ("1", "b"), ("5", "kept")]
    with pytest.raises(ValueError):
        sources.write_model(jobs, skills, "elsewhere", str(tmp_path / "x"))
    with pytest.raises(ValueError):
        sources.write_model(jobs, skills, "database", str(tmp_path / "x"))


def test_schema_is_created_once_and_nulls_are_found(spark, tmp_path):
    spark.sql(f"CREATE DATABASE textmart_schema LOCATION '{tmp_path}/db'")
    for _ in range(2):
        sources.ensure_schema(spark, "textmart_schema")
    tables = {r["tableName"] for r in spark.sql("SHOW TABLES IN textmart_schema").collect()}
    assert tables == {"job_html", "jobs", "job_skills"}
    spark.sql("INSERT INTO textmart_schema.job_html VALUES ('1', '<p>', timestamp '2024-01-01')")
    assert rows(sources.read_html_cache_table(spark, "textmart_schema.job_html")) == [("1", "<p>")]
    # The declared NOT NULL is not enforced; the check finds the row.
    spark.sql("INSERT INTO textmart_schema.job_skills VALUES ('1', NULL)")
    found = null_violations(spark.table("textmart_schema.job_skills"), ["job_id", "skill"])
    assert rows(found) == [("1", None, ["skill"])]
    spark.sql("DROP DATABASE textmart_schema CASCADE")


DICTIONARY = [("SQL", "sql", 0), ("Python", "python", 1), ("Power BI", "power bi", 2)]


def posting(title, body, city="SP"):
    return (
        f'<h2 class="top-card-layout__title topcard__title">{title}</h2>'
        f'<a class="topcard__org-name-link">Org</a><span class="topcard__flavor topcard__flavor--bullet">{city}</span>'
        f'<div class="show-more-less-html__markup"><p>{body}</p></div>'
    )


def test_extract_and_analyse(spark, tmp_path):
    """From cached pages to reports, with a processed and an unlisted posting."""
    dictionary = spark.createDataFrame(DICTIONARY, "canonical STRING, alias STRING, pos INT")
    cache = spark.createDataFrame(
        [
            ("1", posting("Analista de Dados Pleno/Sênior", "SQL, Power-BI e python. Remoto")),
            ("2", posting("Engenheiro de Dados Jr", "sql", "Híbrido")),
            ("3", posting("Vendedor", "nada")),
            ("4", posting("Engenheiro de Dados", "python")),
        ],
        "job_id STRING, html_text STRING",
    )
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("8",)], "job_id STRING")
    done = spark.createDataFrame([("3",)], "job_id STRING")
    assert rows(extract.fetch_backlog(ids, cache)) == [("8",)]
    want = [
        ("1", "Analista de Dados Pleno/Sênior", "Org", "SP", "remoto", ["Power BI", "Python", "SQL"]),
        ("2", "Engenheiro de Dados Jr", "Org", "Híbrido", "hibrido", ["SQL"]),
    ]
    for path in ("native", "parser"):
        assert rows(extract.extract_pending(ids, cache, done, dictionary, path=path)) == want
    offline = extract.extract_offline(cache, done, dictionary)
    assert rows(offline) == want + [("4", "Engenheiro de Dados", "Org", "SP", None, ["Python"])]

    jobs, skills = normalize(offline)
    mart = analyse.build_mart(jobs, skills).cache()
    assert mart.count() == 3 * 2 + 1 + 1
    assert [tuple(r) for r in analyse.group_ranking(mart).collect()] == [("Data Engineer", 2), ("Data Analyst", 1)]
    assert [tuple(r) for r in analyse.top_skills(mart, 2).collect()] == [("Python", 2), ("Sql", 2)]
    assert [tuple(r) for r in analyse.level_shares(mart).collect()] == [
        ("junior", "Júnior", 1, 33.3, "33.3%"),
        ("nao_especificado", "Não especificado", 1, 33.3, "33.3%"),
        ("pleno", "Pleno", 1, 33.3, "33.3%"),
        ("senior", "Sênior", 1, 33.3, "33.3%"),
    ]
    assert [tuple(r) for r in analyse.work_mode_shares(jobs).collect()] == [("hibrido", 1, 33.3), ("remoto", 1, 33.3)]
    assert tuple(analyse.mart_summary(mart).first()) == (8, 3, 3, 3)
    top = analyse.top_skills_per_group(mart, 1).orderBy("position_group").collect()
    assert [(r["position_group"], r["skill_grouped"], r["n"], r["rank"]) for r in top] == [
        ("Data Analyst", "Power BI", 1, 1), ("Data Engineer", "Python", 1, 1)]
    sources.write_mart_csv(mart, str(tmp_path / "mart"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "mart"))) == rows(mart)


def test_unprocessed_pages_both_ways(spark):
    cache = spark.createDataFrame([(str(i), f"p{i}") for i in range(9)], "job_id STRING, html_text STRING")
    jobs = spark.createDataFrame([("1",), ("1",), ("4",), ("77",)], "job_id STRING")
    want = [(str(i), f"p{i}") for i in range(9) if i not in (1, 4)]
    for small in (100, 0):
        assert rows(extract.unprocessed_pages(cache, jobs, small=small)) == want


def test_dictionary_csv(spark, tmp_path):
    file = tmp_path / "dictionary.csv"
    file.write_text('canonical,alias,pos\nIngles,"english (advanced)",1\n"PL/SQL",pl/sql,2\n')
    assert rows(sources.read_dictionary(spark, str(file))) == [("Ingles", "english (advanced)", 1), ("PL/SQL", "pl/sql", 2)]


def test_default_appends_follow_any_stored_number(spark, tmp_path):
    schema = "job_id STRING, html_text STRING"
    one = lambda text: spark.createDataFrame([("1", text), ("2", "kept")], schema).repartition(2)
    path = str(tmp_path / "html")
    for text, how in (("a", {}), ("b", {"batch": 7}), ("c", {}), ("d", {})):
        sources.write_html_csv(one(text), path, **how)
        assert rows(sources.read_html_cache_csv(spark, path)) == [("1", text), ("2", "kept")]
    sources.write_html_csv(one("e").withColumn("seq", F.lit(40)), path)
    sources.write_html_csv(one("f"), path)
    assert rows(sources.read_html_cache_csv(spark, path)) == [("1", "f"), ("2", "kept")]
    # Without the note the files tell.
    import shutil

    shutil.copytree(path, tmp_path / "bare", ignore=lambda _, names: [n for n in names if n == "_appends"])
    sources.write_html_csv(one("g"), str(tmp_path / "bare"))
    assert rows(sources.read_html_cache_csv(spark, str(tmp_path / "bare"))) == [("1", "g"), ("2", "kept")]
