"""Sinks. Each is one distributed write; no sink overwrites what its plan reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textmart import schemas as S
from textmart.functions.text import collapse_newlines
from textmart.operators import quality
from textmart.operators.model import one_per_key, project, replace_children, upsert
from textmart.sources.read import load_or_empty, read_csv


def _csv(df: DataFrame, mode: str, quote_all: bool = False):
    return (
        df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        .option("quoteAll", quote_all)
        # Keep blanks at both ends and write NULL as an empty field.
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )


def append_ids_csv(ids: DataFrame, path: str) -> None:
    """Append (job_id, url) rows; every part file carries the header."""
    _csv(project(ids, S.JOB_IDS), "append").csv(path)


def write_html_csv(pages: DataFrame, path: str, batch: int | None = None) -> None:
    """Append (job_id, html_text, seq), all fields quoted, newline runs as one blank.

    Tasks write at any time and under any name, so the order of appends is kept in
    `seq`: the rows' own, or the number of the append, `batch`; without either the
    number after the highest stored one. What was given out is noted in a folder beside
    the files, so that the pages are read for it only where that note is missing. One
    append runs at a time.
    """
    spark, seen = pages.sparkSession, Observation()
    if "seq" not in pages.columns:
        number = _last_seq(spark, path) + 1 if batch is None else batch
        pages = pages.withColumn("seq", F.lit(number).cast("long"))
        # Noted before the rows are there: an append that fails leaves a gap.
        _note_seq(spark, path, number)
        observed = pages
    else:
        observed = pages.observe(seen, F.max(F.col("seq").cast("long")).alias("seq"))
    clean = project(observed, S.JOB_HTML_CSV).withColumn(
        "html_text", collapse_newlines(F.col("html_text"))
    )
    _csv(clean, "append", quote_all=True).csv(path)
    if observed is not pages and seen.get["seq"] is not None:
        _note_seq(spark, path, seen.get["seq"])


# Spark's readers pass over names with an underscore.
_SEQS = "_appends"


def _note_seq(spark: SparkSession, path: str, number: int) -> None:
    spark.createDataFrame([(number,)], "seq LONG").coalesce(1).write.mode("append").json(f"{path}/{_SEQS}")


def _last_seq(spark: SparkSession, path: str) -> int:
    """The highest number given to an append; -1 where there is none."""
    noted = load_or_empty(spark, lambda: spark.read.schema("seq LONG").json(f"{path}/{_SEQS}"), "seq LONG")
    last = noted.agg(F.max("seq")).first()[0]
    if last is None:
        stored = load_or_empty(spark, lambda: read_csv(spark, S.JOB_HTML_CSV, path), S.JOB_HTML_CSV)
        last = stored.agg(F.max("seq")).first()[0]
    return -1 if last is None else last


def write_entries_json(entries: DataFrame, path: str) -> None:
    """Rewrite the nested entries as JSON lines, NULL fields included."""
    project(entries, S.ENTRY).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_mart_csv(mart: DataFrame, path: str) -> None:
    _csv(project(mart, S.MART), "overwrite").csv(path)


def write_model(
    jobs: DataFrame,
    skills: DataFrame,
    sink: str,
    path: str,
    current: tuple[DataFrame, DataFrame] | None = None,
    columns: list[str] = S.JOB_COLUMNS[1:],
    key: str = "job_id",
    item: str = "skill",
    seq: str | None = None,
) -> None:
    """Persist the model to the sink the setting names.

    `jobs` and the pairs in `skills` may come from `normalize`; jobs new to the tables
    get the current time unless they carry a `created_at`.

    'local': both relations are overwritten as CSV, every skill row kept, with or
    without a parent. 'database': jobs are upserted into the `current` tables and
    the skills of exactly these jobs are replaced, orphans dropped; the result is
    written as parquet to `path`, which must not be where `current` is read from. Of a
    repeated job the last row by `seq` counts; without `seq` repeated jobs are refused.
    Both relations are read several times: `plans.extract.staged` stores them first.
    """
    if sink == "local":
        _csv(jobs.select(key, *columns), "overwrite").csv(f"{path}/jobs")
        _csv(skills.select(key, item), "overwrite").csv(f"{path}/job_skills")
    elif sink == "database":
        if current is None:
            raise ValueError("the database sink merges into current tables")
        base, children = current
        jobs = one_per_key(jobs, key, seq)
        if "created_at" not in jobs.columns:
            jobs = jobs.withColumn("created_at", F.current_timestamp())
        upsert(base, jobs, key, columns, keep=["created_at"]).write.parquet(f"{path}/jobs")
        replace_children(children, jobs, skills, key, item).write.parquet(f"{path}/job_skills")
    else:
        raise ValueError(f"unknown sink {sink!r}")


def write_checked_model(
    jobs: DataFrame, skills: DataFrame, sink: str, path: str, on_violation: str = "refuse",
    domains: dict[str, list[str]] | None = None, key: str = "job_id", item: str = "skill", seq: str | None = None, **how,
) -> dict[str, dict[str, int]]:
    """`write_model` behind the tables' constraints; the numbers of rows and offences by table.

    Jobs have a key, once (or an order of writes, `seq`), and values in their `domains`; skills have a key,
    a value and a parent among the good jobs. 'refuse' writes nothing if any row offends;
    'quarantine' writes the good rows, and the others with their reasons below `path`/quarantine.
    Both relations are read once.
    """
    parents = quality.checked(jobs, [key], domains, [] if seq else [key])
    children = quality.checked(skills, [key, item], parents=parents.good, parent_key=key)
    if on_violation == "refuse":
        quality.refuse(jobs=parents, skills=children)
    elif on_violation == "quarantine":
        for name, part in (("jobs", parents), ("job_skills", children)):
            part.bad.write.mode("overwrite").parquet(f"{path}/quarantine/{name}")
    else:
        raise ValueError(f"unknown way {on_violation!r}")
    write_model(parents.good, children.good, sink, path, key=key, item=item, seq=seq, **how)
    return {"jobs": parents.counts, "job_skills": children.counts}


def ensure_schema(spark: SparkSession, database: str = "default") -> None:
    """Create the three tables if absent.

    Parquet tables can declare NOT NULL only, and Spark does not enforce it on
    write; all constraints are checked by the queries of `operators.model`.
    """
    ddl = {
        "job_html": "job_id STRING NOT NULL, html_text STRING NOT NULL, "
        "fetched_at TIMESTAMP NOT NULL",
        "jobs": "job_id STRING NOT NULL, title STRING, company STRING, city STRING, "
        "work_mode STRING, created_at TIMESTAMP NOT NULL",
        "job_skills": "job_id STRING NOT NULL, skill STRING NOT NULL",
    }
    for table, columns in ddl.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet")
