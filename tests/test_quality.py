import pytest

from textmart import sources
from textmart.operators import quality

JOBS = [("1", "t", "remote"), ("2", "t", "moon"), (None, "t", None), ("3", "a", None), ("3", "b", None), ("4", None, "moon"), (None, "x", "moon")]
SKILLS = [("1", "a"), ("1", None), ("2", "b"), ("9", "c"), (None, None), ("1", "a")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def model(spark):
    return spark.createDataFrame(JOBS, "job_id STRING, title STRING, work_mode STRING"), spark.createDataFrame(SKILLS, "job_id STRING, skill STRING")


def test_rows_are_split_with_their_reasons(spark):
    jobs, skills = model(spark)
    got = quality.checked(jobs, ["job_id"], {"work_mode": ["remote"]}, ["job_id"])
    assert rows(got.good) == [("1", "t", "remote")]
    want = [("2", ["domain:work_mode"]), ("3", ["repeated"]), ("3", ["repeated"]), ("4", ["domain:work_mode"]), (None, ["null:job_id", "domain:work_mode"]), (None, ["null:job_id"])]
    assert rows(got.bad.select("job_id", "reasons")) == sorted(want, key=repr)
    assert got.counts == {"rows": 7, "null:job_id": 2, "domain:work_mode": 3, "repeated": 2}
    children = quality.checked(skills, ["job_id", "skill"], parents=got.good, parent_key="job_id")
    assert rows(children.good) == [("1", "a"), ("1", "a")] and children.counts["orphan"] == 2
    empty = quality.checked(jobs.limit(0), ["job_id"], keys=["job_id"])
    assert rows(empty.good) == rows(empty.bad) == [] and set(empty.counts.values()) == {0}


def test_rows_are_made_once(spark, tmp_path):
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            made.add(batch.num_rows)
            yield batch

    jobs, skills = model(spark)
    jobs = jobs.mapInArrow(count, jobs.schema)
    sources.write_checked_model(jobs, skills, "local", str(tmp_path / "m"), "quarantine", {"work_mode": ["remote"]}, columns=["title", "work_mode"])
    assert made.value == len(JOBS)
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "m" / "jobs")).select("job_id")) == [("1",)]
    assert spark.read.parquet(str(tmp_path / "m" / "quarantine" / "job_skills")).where(F.array_contains("reasons", "orphan")).count() == 2


def test_a_sink_that_refuses_writes_nothing(spark, tmp_path):
    jobs, skills = model(spark)
    path = tmp_path / "m"
    with pytest.raises(quality.ConstraintError, match="jobs null:job_id: 2 rows"):
        sources.write_checked_model(jobs, skills, "local", str(path), columns=["title", "work_mode"])
    assert not path.exists()
    told = sources.write_checked_model(jobs.where("job_id = '1'"), skills.limit(1), "local", str(path), columns=["title", "work_mode"])
    assert told == {"jobs": {"rows": 1, "null:job_id": 0, "repeated": 0}, "job_skills": {"rows": 1, "null:job_id": 0, "null:skill": 0, "orphan": 0}}
    with pytest.raises(ValueError, match="unknown way"):
        sources.write_checked_model(jobs, skills, "local", str(path), "elsewhere")
