"""Rules for the given tables: their text is invented, so no real term occurs in it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from textmart import rules as R
from textmart.functions.html import Field
from textmart.plans.extract import PageLayout
from textmart.schemas import CASCADE, DICTIONARY, EXACT_MAP

# canonical, alias: common words of the four languages, with aliases of two and
# three words, shared beginnings, accents, and spellings joined in the text.
TERMS = [
    ("The", "the"),
    ("Of The", "of the"),
    ("Of The", "of-the"),
    ("In The", "in the"),
    ("To", "to"),
    ("To The", "to the"),
    ("And The", "and the"),
    ("And", "and"),
    ("The Of", "the of the"),
    ("On", "on onst"),
    ("That In", "that in"),
    ("With", "with"),
    ("De", "de"),
    ("De La", "de la"),
    ("La", "la"),
    ("Le", "le"),
    ("Les", "les"),
    ("Der", "der"),
    ("Die Der", "die/der"),
    ("Und", "und"),
    ("Für", "für"),
    ("Nicht", "nicht"),
    ("El", "el"),
    ("Los", "los"),
    ("Con", "con"),
    ("É", "é"),
]

# Three kinds of words for the mode rule, on folded text.
MODE_WORDS = [
    ("mixed", r"\bsich\b|\bdans\b"),
    ("latin", r"\bque\b|\bla\b|\bles\b"),
    ("germanic", r"\bwith\b|\bund\b|\bof the\b"),
]

# Ordered keyword rules for part names ("adjective noun").
NAME_RULES = [
    ("Ring Family", ["ring"]),
    ("Fastener", ["bolt", "rod"]),
    ("Warm Stock", ["hot "]),
    ("Machine", ["gear", "gizmo", "widget"]),
    ("Small Stock", ["small", "old"]),
]
NAME_DEFAULT = "Other"

NAME_LEVELS = [
    ("size", r"\bsmall\b|\blarge\b"),
    ("heat", r"\bhot\b|\bcold\b"),
    ("colour", r"\bred\b|\bblue\b"),
    ("round", r"ring|\brod\b|gear"),
]
NAME_LEVEL_DEFAULT = "plain"

# Order priorities as messy names.
PRIORITY_NAMES = {"1-urgent": "URGENT", "5-low": "Low"}
PRIORITY_PARTS = [("Unknown", ["specified"]), ("Elevated", ["high"])]

# Skill stand-ins are "returnflag/linestatus" pairs of a line item.
PAIR_NAMES = {"a/f": "Archived", "n/o": "Open"}
PAIR_PARTS = [("Returned", ["r/"])]
PAIR_MEMBERS = ["archived", "returned"]

ROMANCE = ["fr", "es"]

# Titles for the default rules: levels in several spellings, and every keyword of every group.
DEFAULT_LEVELS = ["Senior", "Jr.", "Estagio em", "Senior/Pleno", "Data Intern |", "Staff", "Mid-Level", "Gerente", "Trainee Junior"]
DEFAULT_KEYWORDS = [k for _, keywords in R.POSITION_RULES for k in keywords]
DEFAULT_NAMES = [*[f" {n.upper()} " for n in R.SKILL_NAMES], *[f"my {p} tool" for _, parts in R.SKILL_NAME_PARTS for p in parts], "unknown thing"]

# Pages: a heading or the page title; no image gives a company, the first link
# does; the advertisement block stands for the city.
PAGE = PageLayout(
    title=(Field.of("h1"), Field.of("title")),
    company=(Field.of("img[data-kind=logo]", "attr:alt"), Field.of("a")),
    city=(Field.of("div.ad"),),
    body=Field.of("article", "text"),
)
LANG = Field.of("html", "attr:lang")
SELECTED = {
    "second_link": ("nav > ul li + li > a[href^='/']", "attr:href"),
    "heading": ("nav ~ article > h1, table h1",),
    "title": ("head > meta[charset] + title",),
    "comma_link": ('nav a[href$=","]',),
    "none": ("article ~ nav a",),
}
LINK_PATTERN = r'href="/([^"]+)"'
# Long link names only, so that some pages show no id at all.
LONG_LINK_PATTERN = r'href="/(\p{L}{6,})'


def dictionary(spark: SparkSession) -> DataFrame:
    return _local(spark, [(c, a, i) for i, (c, a) in enumerate(TERMS)], DICTIONARY)


def name_rules(spark: SparkSession) -> DataFrame:
    rows = [
        (priority, keyword, label)
        for priority, (label, keywords) in enumerate(NAME_RULES)
        for keyword in keywords
    ]
    return _local(spark, rows, CASCADE)


def priority_map(spark: SparkSession) -> DataFrame:
    rows = [("1-URGENT", "today"), ("2-HIGH", "this week"), ("3-MEDIUM", "this month")]
    return _local(spark, rows, EXACT_MAP)


def _local(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small table as a local relation; plain rows would start Python workers."""
    columns = dict(zip(schema.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table(columns), schema)


# Letters of part names and what stands for them in other scripts: a to m, then n to t.
HANGUL = "한국어데터분석가서울부산강"
KANA = "きゃっんしかつ"
