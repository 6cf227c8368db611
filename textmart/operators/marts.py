"""Distinct-count rankings, shares and summaries over the joined model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.functions.literals import explode_computed
from textmart.functions.text import percent


def join_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents without children disappear. A hot parent is split by AQE's skew join."""
    return parents.join(children, key, "inner")


def explode_labels(df: DataFrame, labels: str, out: str) -> DataFrame:
    return explode_computed(df, [c for c in df.columns if c != labels], labels, out)


def excluding(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """NOT IN that keeps NULLs."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(labels)))


def distinct_pairs(df: DataFrame, group: str | Sequence[str], entity: str) -> DataFrame:
    """One row per (group, entity), combined map-side and spread over both columns."""
    groups = [group] if isinstance(group, str) else list(group)
    return _present(df, groups).select(*groups, entity).distinct()


def _present(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    for g in groups:
        df = df.where(F.col(g).isNotNull())
    return df


def entities_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    entity: str,
    out: str = "n",
    unique: bool = False,
) -> DataFrame:
    """Distinct entities per group; the NULL group is dropped, NULL entities not counted.

    The shuffle is on (group, entity), so a group with a third of all rows is
    spread over all tasks; only partial counts meet per group. Where the pairs are
    a key of the data already, `unique` spares that shuffle.
    """
    groups = [group] if isinstance(group, str) else list(group)
    pairs = _present(df, groups) if unique else distinct_pairs(df, groups, entity)
    return pairs.groupBy(*groups).agg(F.count(entity).alias(out))


def rows_per_group(df: DataFrame, group: str, out: str = "n") -> DataFrame:
    """Value counts: rows, not entities; the NULL group is dropped."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias(out))


def ranked(df: DataFrame, count: str, name: str) -> DataFrame:
    """Largest count first, ties by name."""
    return df.orderBy(F.col(count).desc(), F.col(name).asc())


def top(df: DataFrame, count: str, name: str, k: int = 20) -> DataFrame:
    return ranked(df, count, name).limit(k)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A sample for the eye: the first n rows of a stated order."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: str, count: str, name: str, k: int) -> DataFrame:
    """The k largest per group with their rank; `df` holds one row per (group, name).

    Each map task keeps k rows per group before the shuffle (WindowGroupLimit).
    """
    window = Window.partitionBy(group).orderBy(F.col(count).desc(), F.col(name).asc())
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def share_of_entities(
    df: DataFrame, group: str, entity: str, count: str = "n", share: str = "pct"
) -> DataFrame:
    """Distinct entities per group and their percentage of all distinct entities.

    An entity with several labels counts in each, but once in the total, so the
    shares may add up to more than 100. Entities of the NULL group are part of the
    total only. Counts and total start from the same (group, entity) pairs, whose
    shuffle is done once; the total enters the plan as a scalar subquery.
    """
    pairs = df.select(group, entity).distinct()
    # Two things keep the pair shuffle of both plans equal, so that it is reused:
    # the NULL group is dropped by a measure, since a filter on the group itself
    # would be pushed below the shuffle, and the total counts the pairs of each
    # entity, since a plain second distinct would replace the first one.
    counts = (
        pairs.groupBy(group)
        .agg(F.count(entity).alias(count), F.max(F.col(group).isNotNull()).alias("_named"))
        .where("_named")
        .drop("_named")
    )
    per_entity = pairs.groupBy(entity).agg(F.count(F.lit(1)).alias("_pairs"))
    total = per_entity.where("_pairs > 0").agg(F.count(entity)).scalar()
    return counts.withColumn(share, percent(F.col(count), total))


def summary(
    df: DataFrame,
    entity: str,
    item: str,
    label: str,
    label_excluded: str,
    names: Sequence[str] = ("n_rows", "n_entities", "n_items", "n_labelled"),
) -> DataFrame:
    """Rows, distinct entities, distinct items, and distinct entities of known label.

    As in a data frame's `!=`, a NULL label counts as known.
    """
    known = F.when(~F.col(label).eqNullSafe(label_excluded), F.col(entity))
    return df.agg(
        F.count(F.lit(1)).alias(names[0]),
        F.countDistinct(entity).alias(names[1]),
        F.countDistinct(item).alias(names[2]),
        F.countDistinct(known).alias(names[3]),
    )


def distinct_where(df: DataFrame, entity: str, condition: Column, out: str = "n") -> DataFrame:
    return df.agg(F.countDistinct(F.when(condition, F.col(entity))).alias(out))
