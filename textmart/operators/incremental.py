"""Incremental batches: what is new, what is pending, what is seen first.

The sequential rules ("seen so far", "stop at the first empty page") are written
as aggregates that combine map-side, not as windows over a whole key: one id or
one term may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.functions.literals import explode_computed


def nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `other`: new ids, pending jobs, fetch backlog.

    The left side may be skewed (AQE splits it); the right side is one row per key.
    """
    return df.join(other.select(key).distinct(), key, "left_anti")


def not_in_store(batch: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """`not_in` for a small batch against a huge store.

    Only the store's keys that occur in the batch are wanted. The semi join has
    the batch as its right side, so AQE can broadcast it and read the store
    without a shuffle; the anti join is then small against small.
    """
    wanted = batch.select(key).distinct()
    return not_in(batch, store.select(key).join(wanted, key, "left_semi"), key)


def in_cache(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return df.join(cache.select(key).distinct(), key, "left_semi")


def worklist_status(
    ids: DataFrame, processed: DataFrame, cached: DataFrame, key: str, may_fetch: bool
) -> DataFrame:
    """One status per distinct id: processed, cached, to-fetch or no-html."""
    done = processed.select(key).distinct().withColumn("_done", F.lit(True))
    have = cached.select(key).distinct().withColumn("_have", F.lit(True))
    return (
        ids.select(key)
        .distinct()
        .join(done, key, "left")
        .join(have, key, "left")
        .select(
            key,
            F.when(F.col("_done"), "processed")
            .when(F.col("_have"), "cached")
            .otherwise("to-fetch" if may_fetch else "no-html")
            .alias("status"),
        )
    )


def url_frontier(
    terms: DataFrame, template: str, pages: int, step: int, keep: list[str]
) -> DataFrame:
    """One row per term and page with its URL; no page gives no row.

    `template` is a printf format taking the term and the start offset. Pages are
    generated inside each term's row, so there is no join.
    """
    rows = terms.select(
        *keep, "term", F.explode(F.sequence(F.lit(0), F.lit(max(pages - 1, 0)))).alias("page")
    ).where(F.lit(pages > 0))
    return rows.withColumn("url", F.format_string(template, "term", F.col("page") * step))


def take_while(df: DataFrame, key: str, order: str, keep: Column) -> DataFrame:
    """Per key, the rows before the first one (by `order`) where `keep` fails."""
    stops = (
        df.where(~keep)
        .groupBy(F.col(key).alias("_stop_key"))
        .agg(F.min(order).alias("_stop_at"))
    )
    return (
        df.join(stops, F.col(key) == F.col("_stop_key"), "left")
        .where(F.col("_stop_at").isNull() | (F.col(order) < F.col("_stop_at")))
        .drop("_stop_key", "_stop_at")
    )


def item_counts(pages: DataFrame, ids: str, page: str, id_name: str) -> DataFrame:
    """(page, id, copies on that page), counted inside each page's own row.

    The counts are run lengths of the sorted array, so no shuffle is needed.
    """
    sorted_ids = pages.select(F.col(page).alias("_page"), F.array_sort(F.array_compact(ids)).alias("_ids"))
    starts = sorted_ids.select(
        "_page",
        F.size("_ids").alias("_size"),
        F.filter(
            F.transform("_ids", lambda x, i: F.struct(x.alias("id"), i.alias("at"))),
            lambda s: (s["at"] == 0) | (F.get("_ids", s["at"] - 1) != s["id"]),
        ).alias("_runs"),
    )
    run_end = lambda i: F.coalesce(F.get("_runs", i + 1)["at"], F.col("_size"))
    return starts.select(
        "_page",
        F.inline_outer(
            F.transform(
                "_runs",
                lambda r, i: F.struct(r["id"].alias(id_name), (run_end(i) - r["at"]).alias("_n")),
            )
        ),
    ).where(F.col(id_name).isNotNull())


def first_seen(pages: DataFrame, ids: str, page: str, id_name: str = "job_id") -> DataFrame:
    """(id, page) rows that keep each id on the first page that shows it.

    An id shown twice on its first page is kept twice; later pages lose it. One
    aggregate over primitive values (combined map-side) finds the first page, so
    no task ever holds the rows of a hot id.
    """
    first = (
        item_counts(pages, ids, page, id_name)
        .groupBy(id_name)
        .agg(F.min("_page").alias(page), F.min_by("_n", "_page").alias("_n"))
    )
    return first.select(id_name, page, F.explode(F.sequence(F.lit(1), "_n"))).drop("col")


def first_seen_strict(pages: DataFrame, ids: str, page: str, id_name: str = "job_id") -> DataFrame:
    """`first_seen` without in-page duplicates: one row per id."""
    shown = explode_computed(pages, [page], ids, id_name)
    return shown.groupBy(id_name).agg(F.min(page).alias(page))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that are not in `right`."""
    return left.subtract(right)
