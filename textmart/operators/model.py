"""The parent/child model: shaping, merging and checking `jobs` and `job_skills`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmart.functions.literals import explode_computed
from textmart.sizes import dealt, looked_up


# --- shaping -----------------------------------------------------------------


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema` in its order; absent ones become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def normalize(
    entries: DataFrame, key: str = "job_id", items: str = "skills", item: str = "skill"
) -> tuple[DataFrame, DataFrame]:
    """Nested entries -> (parents, children); an empty array gives no child row."""
    parents = entries.drop(items)
    return parents, explode_computed(entries, [key], items, item)


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True)


def children_by_parent(
    parents: DataFrame, children: DataFrame, key: str, item: str, out: str
) -> DataFrame:
    """Each parent with the sorted list of its children, [] if it has none.

    Equal children are counted per (parent, child) before they are gathered, but the
    list holds them all: for parents with very many children use `child_counts`.
    """
    counted = children.groupBy(key, item).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    lists = counted.groupBy(key).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col(item).alias("v"), F.col("_n").alias("n")))
        ).alias("_l")
    )
    repeated = F.flatten(F.transform("_l", lambda s: F.array_repeat(s["v"], s["n"])))
    empty = F.array().cast(T.ArrayType(children.schema[item].dataType))
    return (
        parents.join(lists, key, "left")
        .withColumn(out, F.coalesce(repeated, empty))
        .drop("_l")
    )


def child_counts(
    parents: DataFrame, children: DataFrame, key: str, item: str, out: str = "n"
) -> DataFrame:
    """A row for each parent and different child with its count; (NULL, 0) without a child.

    Counted map-side and spread over (parent, child): no parent makes a large row or task.
    """
    counted = children.groupBy(key, item).agg(F.count(F.lit(1)).alias(out))
    return parents.join(counted, key, "left").withColumn(out, F.coalesce(out, F.lit(0)))


# --- merging -----------------------------------------------------------------


def latest(df: DataFrame, key: str | Sequence[str], seq: str | Column) -> DataFrame:
    """Last write wins: the row with the largest `seq` of each key.

    The rank filter is applied before the shuffle too (WindowGroupLimit), so a key
    that holds a third of the rows leaves each map task with one row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = F.col(seq) if isinstance(seq, str) else seq
    window = Window.partitionBy(*keys).orderBy(order.desc())
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def one_per_key(batch: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """A batch as a sink may merge it: with `seq` the last write of each key, without the column.

    Without `seq` there is no telling which write is the last; a batch with a repeated
    key is refused.
    """
    if seq is not None:
        return latest(batch, key, seq).drop(seq)
    repeated = key_violations(batch.where(F.col(key).isNotNull()), [key])
    if not repeated.isEmpty():
        raise ValueError(f"the batch repeats values of {key}: name a column that orders its rows")
    return batch


def upsert(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys and overwrite `columns` of known ones, NULLs included.

    `keep` columns (a creation time) stay as they are on known keys. Both sides
    have unique keys; run `latest` on a batch that may not. The joins keep the large
    base in place when the batch is small enough for AQE to broadcast it, a full
    outer join would always shuffle and sort the base.
    """
    # Said once for all uses of the batch, so that they share its shuffle.
    updates = updates.where(F.col(key).isNotNull())
    new = updates.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_u_{c}") for c in [*columns, *keep]]
    )
    hit = F.col("_key").isNotNull()
    updated = base.join(new, F.col(key) == F.col("_key"), "left").select(
        key,
        *[F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        *keep,
    )
    known = base.select(key).join(updates.select(key), key, "left_semi")
    inserted = updates.join(known, key, "left_anti").select(key, *columns, *keep)
    return updated.unionByName(inserted)


def upsert_pages(
    cache: DataFrame, pages: DataFrame, key: str = "job_id", html: str = "html_text",
    seq: str | None = None,
) -> DataFrame:
    """The page cache with newer pages; known ids get the new text and fetch time.

    Of a page fetched more than once the last write, by `seq`, counts.
    """
    pages = one_per_key(pages, key, seq)
    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.current_timestamp())
    return upsert(cache, pages, key, [html, "fetched_at"])


def insert_ignore(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows whose composite key is not there yet, one per key.

    Both sides meet in tasks of a number of rows; the base's keys follow the dealt side.
    """
    there = base.select(*keys)
    fresh = dealt(new, *keys, beside=there).dropDuplicates(list(keys)).join(there, list(keys), "left_anti")
    return base.unionByName(fresh)


def replace_children(
    children: DataFrame, parents: DataFrame, new: DataFrame, key: str, item: str
) -> DataFrame:
    """Children after each incoming parent's set was replaced by its new one.

    A parent without new children loses its old ones. New children of no incoming
    parent are dropped, as the table sink does. Children are neither sorted nor held in
    a task, but for the tables of different pairs, dealt by row.
    """
    incoming = looked_up(parents.select(key).distinct())
    kept = children.join(incoming, key, "left_anti")
    fresh = dealt(new.select(key, item), key, item).distinct().join(incoming, key, "left_semi")
    return kept.select(key, item).unionByName(fresh)


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Children that survive the removal of the given parents."""
    return children.join(deleted.select(key).distinct(), key, "left_anti")


# --- constraint checks: each returns the offending rows ----------------------


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key).distinct(), key, "left_anti")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that hold a NULL in a required column, with the columns' names."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("missing", missing).where(F.size("missing") > 0)
