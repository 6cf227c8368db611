"""Declared schemas. Ids are text everywhere and are never cast to numbers."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


JOB_IDS = T.StructType(_text("job_id", "url"))
JOB_HTML_CSV = T.StructType(
    _text("job_id", "html_text") + [T.StructField("seq", T.LongType(), True)]
)
JOB_HTML = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("html_text", T.StringType(), False),
        T.StructField("fetched_at", T.TimestampType(), False),
    ]
)
ENTRY = T.StructType(
    _text("job_id", "title", "company", "city", "work_mode")
    + [T.StructField("skills", T.ArrayType(T.StringType(), True), True)]
)
JOB_COLUMNS = ["job_id", "title", "company", "city", "work_mode"]
JOBS = T.StructType(
    [T.StructField("job_id", T.StringType(), False)]
    + _text("title", "company", "city", "work_mode")
    + [T.StructField("created_at", T.TimestampType(), False)]
)
JOBS_CSV = T.StructType(_text(*JOB_COLUMNS))
JOB_SKILLS = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("skill", T.StringType(), False),
    ]
)
MART_COLUMNS = [
    "job_id",
    "title",
    "company",
    "city",
    "work_mode",
    "position_group",
    "level",
    "skill",
    "skill_grouped",
    "tipo_skill",
]
MART = T.StructType(_text(*MART_COLUMNS))
DICTIONARY = T.StructType(
    _text("canonical", "alias") + [T.StructField("pos", T.IntegerType(), False)]
)
CASCADE = T.StructType(
    [T.StructField("priority", T.IntegerType(), False)] + _text("keyword", "label")
)
EXACT_MAP = T.StructType(_text("key", "value"))
