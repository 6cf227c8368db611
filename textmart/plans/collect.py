"""Id collection as one batch over fetched result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart import rules as R
from textmart.functions.html import extract_ids
from textmart.operators.incremental import first_seen, not_in_store, take_while
from textmart.session import scratch_path


def page_ids(pages: DataFrame, pattern: str = R.ID_PATTERN) -> DataFrame:
    """(term_ord, page, url, ids) of pages (term_ord, page, url, html)."""
    return pages.select(
        "term_ord", "page", "url", extract_ids(F.col("html"), pattern).alias("ids")
    )


def new_ids(found: DataFrame, stored: DataFrame) -> DataFrame:
    """New (job_id, url) rows of `page_ids`.

    A term's pages count up to its first page without any id; a page that shows
    only known ids does not stop it. Pages are ordered by (term_ord, page).
    Of a repeated page one row counts, that with the first URL. `found` is read more
    than once: `collect_ids` stores it, it is narrow.
    """
    once = found.groupBy("term_ord", "page").agg(F.min(F.struct("url", "ids")).alias("p"))
    found = once.select("term_ord", "page", "p.url", "p.ids")
    read = take_while(found, "term_ord", "page", F.size("ids") > 0)
    new = not_in_store(first_seen(_ordered(read), "ids", "page_ord"), stored, "job_id")
    return new.join(_ordered(found).select("page_ord", "url"), "page_ord").select("job_id", "url")


def collect_ids(
    pages: DataFrame, stored: DataFrame, pattern: str = R.ID_PATTERN
) -> DataFrame:
    """New (job_id, url) rows; the pages are read once."""
    path = scratch_path(pages.sparkSession, "page-ids")
    found = page_ids(pages, pattern)
    found.write.parquet(path)
    return new_ids(pages.sparkSession.read.schema(found.schema).parquet(path), stored)


def _ordered(pages: DataFrame) -> DataFrame:
    """One number orders the pages of all terms."""
    order = F.col("term_ord").cast("long") * F.lit(1 << 32) + F.col("page")
    return pages.withColumn("page_ord", order)
