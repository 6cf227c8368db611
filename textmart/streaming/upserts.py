"""Extraction results upserted as a stream.

Parquet has no MERGE, and rewriting a large table for every micro-batch would cost
the table each time. So a batch appends its own resolved rows under
`changes/batch_id=N` (work in proportion to the batch), a commit row in `commits`
makes them visible, and `current` resolves last-write-wins when read. `compact`
folds the changes into a snapshot now and then.

N counts the writes to the store, whichever checkpoint they come from. A batch is known by its
checkpoint's id and its number there: once committed it is not written again, and an
attempt that ended before its commit is written anew under a new N, after all writes
committed meanwhile. So a new checkpoint over an old store overwrites nothing, and no
write is numbered below a snapshot. One stream writes to a store at a time.

A row carries its children as an array: since an upsert replaces all children of
a parent, the latest row of a key holds exactly its current children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmart.operators.model import latest
from textmart.plans.extract import build_entries
from textmart.sizes import broadcast_if_small
from textmart.sources.read import load_or_empty
from textmart.streaming.first_seen import _run_available

_COMMIT = "kind STRING, batch_id LONG, run STRING, run_batch LONG"


def stream_upsert(
    rows: DataFrame, key: str, seq: str, store: str, checkpoint: str, created: str = "created_at"
) -> StreamingQuery:
    """Upsert each micro-batch by `key`; inside a batch the largest `seq` wins."""

    def write(batch: DataFrame, batch_id: int) -> None:
        resolved = latest(batch, key, seq)
        if created not in resolved.columns:
            resolved = resolved.withColumn(created, F.current_timestamp())
        _apply(resolved, store, checkpoint, batch_id)

    return _run_available(rows, write, checkpoint)


def stream_extract_upsert(
    pages: DataFrame, dictionary: DataFrame, seq: str, store: str, checkpoint: str,
    key: str = "job_id", html: str = "html_text", **how,
) -> StreamingQuery:
    """Pages as they arrive -> entries -> upsert with their children.

    Of a page that arrives more than once in a micro-batch the largest `seq` is extracted.
    Each micro-batch is extracted once, with a dictionary of any size.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        pages_once = latest(batch, key, seq).select(key, html)
        entries = build_entries(pages_once, dictionary, key=key, html=html, **how)
        entries = entries.withColumn("created_at", F.current_timestamp())
        _apply(entries, store, checkpoint, batch_id)

    return _run_available(pages, write, checkpoint)


def current(
    spark: SparkSession, store: str, key: str, created: str = "created_at"
) -> DataFrame:
    """The upserted table: latest values per key, creation time of the first write."""
    base, upto = _snapshot(spark, store)
    # One narrow row for each write since the snapshot.
    made = _commits(spark, store).where((F.col("kind") == "changes") & (F.col("batch_id") > upto))
    made = broadcast_if_small(made.select("batch_id").distinct())
    changes = (
        spark.read.option("basePath", f"{store}/changes")
        .parquet(f"{store}/changes")
        .withColumn("batch_id", F.col("batch_id").cast("long"))
        .join(made, "batch_id", "left_semi")
    )
    # Only the changes are resolved; the snapshot has one row per key and stays in place.
    by_batch = Window.partitionBy(key).orderBy(F.col("batch_id").desc())
    whole = by_batch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    resolved = (
        changes.withColumn(created, F.last(created).over(whole))
        .withColumn("_rn", F.row_number().over(by_batch))
        .where("_rn = 1")
        .drop("_rn")
    )
    if base is None:
        return resolved
    known = base.select(key, F.col(created).alias("_known"))
    renewed = resolved.join(known, key, "left").withColumn(created, F.coalesce("_known", created))
    untouched = base.join(resolved.select(key), key, "left_anti")
    return untouched.unionByName(renewed.drop("_known"))


def compact(spark: SparkSession, store: str, key: str, created: str = "created_at") -> None:
    """Write the current table as a new snapshot; older changes are no longer read."""
    last, upto = _last_commit(spark, store, "changes"), _last_commit(spark, store, "snapshot")
    if last <= upto:
        return
    current(spark, store, key, created).write.mode("overwrite").parquet(
        f"{store}/snapshot-{last}"
    )
    _commit(spark, store, "snapshot", last)


def children_of(table: DataFrame, key: str, items: str, item: str) -> DataFrame:
    return table.select(key, F.explode(items).alias(item))


def _apply(rows: DataFrame, store: str, checkpoint: str, run_batch: int) -> None:
    """Write a micro-batch's rows and commit them, unless this batch is committed already."""
    spark = rows.sparkSession
    run = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    commits = _commits(spark, store)
    own = (F.col("kind") == "changes") & (F.col("run") == run) & (F.col("run_batch") == run_batch)
    if not commits.where(own).isEmpty():
        return
    # Numbers once begun are not given again: what was not committed is never read.
    number = commits.agg(F.coalesce(F.max("batch_id"), F.lit(-1)) + 1).first()[0]
    _commit(spark, store, "begun", number, run, run_batch)
    rows.write.mode("overwrite").parquet(f"{store}/changes/batch_id={number}")
    _commit(spark, store, "changes", number, run, run_batch)


def _commit(
    spark: SparkSession, store: str, kind: str, number: int, run: str | None = None, run_batch: int | None = None
) -> None:
    # An appended row appears at once or not at all.
    row = spark.createDataFrame([(kind, number, run, run_batch)], _COMMIT)
    row.coalesce(1).write.mode("append").json(f"{store}/commits")


def _commits(spark: SparkSession, store: str) -> DataFrame:
    return load_or_empty(spark, lambda: spark.read.schema(_COMMIT).json(f"{store}/commits"), _COMMIT)


def _last_commit(spark: SparkSession, store: str, kind: str) -> int:
    last = _commits(spark, store).where(F.col("kind") == kind).agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def _snapshot(spark: SparkSession, store: str) -> tuple[DataFrame | None, int]:
    upto = _last_commit(spark, store, "snapshot")
    return (None if upto < 0 else spark.read.parquet(f"{store}/snapshot-{upto}")), upto


def has_snapshot(spark: SparkSession, store: str) -> bool:
    return _last_commit(spark, store, "snapshot") >= 0
