"""Entries from posting pages, and the incremental runs over the cache."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart import rules as R
from textmart.functions.classify import work_mode
from textmart.functions.dictionary import match_dictionary
from textmart.functions.html import Field, native_fields, parse_fields, read_fields
from textmart.functions.text import first_nonempty, fold
from textmart.operators.incremental import in_cache, not_in
from textmart.operators.model import normalize
from textmart.session import scratch_path
from textmart.sizes import MAX_BROADCAST_ROWS, is_small


@dataclass(frozen=True)
class PageLayout:
    """Where a page holds its fields; several places are tried in order."""

    title: tuple[Field, ...]
    company: tuple[Field, ...]
    city: tuple[Field, ...]
    body: Field

    def places(self) -> dict[str, Field]:
        named = {"body": self.body}
        for name in ("title", "company", "city"):
            for i, field in enumerate(getattr(self, name)):
                named[f"{name}_{i}"] = field
        return named


POSTING = PageLayout(
    title=tuple(Field.of(s) for s in R.TITLE_SELECTORS),
    company=(Field.of(R.COMPANY_IMAGE, "attr:alt"), Field.of(R.COMPANY_LINK)),
    city=(Field.of(R.CITY_SELECTOR),),
    body=Field.of(R.BODY_SELECTOR, "text"),
)


def page_fields(
    pages: DataFrame,
    layout: PageLayout = POSTING,
    key: str = "job_id",
    html: str = "html_text",
    path: str = "checked",
) -> DataFrame:
    """(key, title, company, city, description) of each page.

    path 'checked' is exact for any markup and native where a page is regular,
    'native' is for markup known to be regular, 'parser' parses every page.
    """
    read = {"checked": read_fields, "native": native_fields, "parser": parse_fields}[path]
    places = layout.places()
    raw = read(pages, key, html, places)

    def first(name: str) -> Column:
        return first_nonempty(*[F.col(p) for p in places if p.startswith(f"{name}_")])

    return raw.select(
        key,
        *[first(name).alias(name) for name in ("title", "company", "city")],
        F.col("body").alias("description"),
    )


def build_entries(
    pages: DataFrame,
    dictionary: DataFrame,
    layout: PageLayout = POSTING,
    key: str = "job_id",
    html: str = "html_text",
    path: str = "checked",
    mode_words: Sequence[tuple[str, str]] = R.MODE_WORDS,
) -> DataFrame:
    """(key, title, company, city, work_mode, skills) of each page."""
    fields = page_fields(pages, layout, key, html, path)
    # Folded once for both uses: folding again passes ASCII text through.
    folded = fields.withColumn("description", fold(F.col("description")))
    matched = match_dictionary(folded, key, "description", dictionary, "skills")
    return matched.select(
        key,
        "title",
        "company",
        "city",
        work_mode(
            F.col("title"), F.col("city"), F.col("description"), words=mode_words
        ).alias("work_mode"),
        "skills",
    )


def staged(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parents, children) of entries that are extracted once and stored in the scratch folder.

    `normalize` gives two plans, and a sink reads each several times; from the stored
    entries none of them reads or parses a page again.
    """
    path = scratch_path(entries.sparkSession, "entries")
    entries.write.parquet(path)
    return normalize(entries.sparkSession.read.schema(entries.schema).parquet(path))


def fetch_backlog(ids: DataFrame, cache: DataFrame, key: str = "job_id") -> DataFrame:
    """Distinct ids that have no page in the cache yet."""
    return not_in(ids.select(key).distinct(), cache, key)


def extract_pending(
    ids: DataFrame, cache: DataFrame, jobs: DataFrame, dictionary: DataFrame, **how
) -> DataFrame:
    """Entries of listed, cached and not yet processed postings.

    What is pending is found on ids alone; the pages meet it in one semi join, with
    the ids on the side that AQE can broadcast.
    """
    key = how.get("key", "job_id")
    pending = not_in(ids.select(key).distinct(), jobs, key)
    return build_entries(in_cache(cache, pending, key), dictionary, **how)


def extract_offline(
    cache: DataFrame, jobs: DataFrame, dictionary: DataFrame, **how
) -> DataFrame:
    """Entries of every cached posting not yet processed.

    Processed postings are not refreshed; to apply a changed dictionary to them,
    run against an empty target.
    """
    key = how.get("key", "job_id")
    return build_entries(unprocessed_pages(cache, jobs, key), dictionary, **how)


def unprocessed_pages(
    cache: DataFrame, jobs: DataFrame, key: str = "job_id", small: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Cached pages of jobs not yet processed, without shuffling pages if possible.

    At first few jobs are processed: their ids are broadcast against the pages.
    Later most are: then the few pending ids are found on ids alone first. The
    wide pages are shuffled only if both sets are large.
    """
    if is_small(jobs, small):
        return not_in(cache, jobs, key)
    # A page without an id is never processed, in either form.
    pending = in_cache(cache, not_in(cache.select(key), jobs, key), key)
    return pending.unionAll(cache.where(F.col(key).isNull()))
