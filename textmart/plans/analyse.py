"""The analysis mart and its reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart import rules as R
from textmart.functions.classify import (
    levels,
    lookup_or_self,
    position_group,
    skill_type,
    standardize_name,
)
from textmart.functions.text import percent_label
from textmart.operators import marts
from textmart.schemas import MART_COLUMNS

ColumnFunction = Callable[[Column], Column]


def build_mart(
    jobs: DataFrame,
    skills: DataFrame,
    group_of: ColumnFunction = position_group,
    levels_of: ColumnFunction = levels,
    name_of: ColumnFunction = standardize_name,
    type_of: ColumnFunction = skill_type,
) -> DataFrame:
    """One row per job, level and skill, with groups, levels and standard names.

    The four classifiers are functions of a column and may be replaced. Titles are classified once per job, before the join multiplies the rows;
    levels are exploded after it, so the shuffle carries each pair once.
    """
    classified = jobs.select(
        "job_id", "title", "company", "city", "work_mode",
        group_of(F.col("title")).alias("position_group"),
        levels_of(F.col("title")).alias("levels"),
    )
    named = skills.select(
        "job_id", "skill", name_of(F.col("skill")).alias("skill_grouped")
    )
    joined = marts.join_children(classified, named, "job_id")
    return (
        marts.explode_labels(joined, "levels", "level")
        .withColumn("tipo_skill", type_of(F.col("skill_grouped")))
        .select(*MART_COLUMNS)
    )


def group_ranking(mart: DataFrame) -> DataFrame:
    counts = marts.entities_per_group(mart, "position_group", "job_id")
    return marts.ranked(counts, "n", "position_group")


def top_skills(mart: DataFrame, k: int = 20) -> DataFrame:
    counts = marts.entities_per_group(mart, "skill_grouped", "job_id")
    return marts.top(counts, "n", "skill_grouped", k)


def top_skills_per_group(mart: DataFrame, k: int) -> DataFrame:
    counts = marts.entities_per_group(mart, ["position_group", "skill_grouped"], "job_id")
    return marts.top_per_group(counts, "position_group", "n", "skill_grouped", k)


def level_shares(mart: DataFrame) -> DataFrame:
    """Level, its display label, jobs and share among the data groups."""
    data = marts.excluding(mart, "position_group", R.POSITION_EXCLUDED)
    shares = marts.share_of_entities(data, "level", "job_id")
    labelled = shares.select(
        "level",
        lookup_or_self(F.col("level"), R.LEVEL_LABELS).alias("label"),
        "n",
        "pct",
        percent_label(F.col("pct")).alias("pct_label"),
    )
    return marts.ranked(labelled, "n", "level")


def work_mode_shares(jobs: DataFrame) -> DataFrame:
    shares = marts.share_of_entities(jobs, "work_mode", "job_id")
    return marts.ranked(shares, "n", "work_mode")


def mart_summary(mart: DataFrame) -> DataFrame:
    return marts.summary(
        mart, "job_id", "skill_grouped", "position_group", R.POSITION_DEFAULT
    )
