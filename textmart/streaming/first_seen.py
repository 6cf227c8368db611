"""Id collection as a stream, with the ids seen so far as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textmart.operators.incremental import item_counts
from textmart.sources.read import load_or_empty
from textmart.streaming.state import keyed_state

_SEEN = "seen BOOLEAN"


class FirstSeen(StatefulProcessor):
    """Keeps of an id that it was seen; gives the first page of an id that was not."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", _SEEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: r[1])
        self.seen.update((True,))
        yield first

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if not self.seen.exists():
            self.seen.update((True,))

    def close(self) -> None:
        pass


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each id of an Arrow batch only its first page, so that a hot id is few rows."""
    for batch in batches:
        item, page, n = batch.schema.names
        ordered = pa.Table.from_batches([batch]).sort_by([(item, "ascending"), (page, "ascending")])
        first = ordered.group_by(item, use_threads=False).aggregate([(page, "first"), (n, "first")])
        yield from first.rename_columns([item, page, n]).to_batches()


def stream_first_seen(
    pages: DataFrame,
    ids: str,
    page: str,
    store: str,
    checkpoint: str,
    id_name: str = "job_id",
    existing: DataFrame | None = None,
) -> StreamingQuery:
    """Exact form: ids seen in any earlier batch are never stored again.

    Which ids were seen is state keyed by id (RocksDB, checkpointed by Spark with each
    micro-batch), so the work of a micro-batch follows its own ids and not the store.
    Of a new id the first page of its micro-batch is stored, in-page duplicates stay.
    A batch writes to a folder of its own below `store`, named by the checkpoint's id and
    the batch number: a replayed batch starts from the state before it and overwrites its
    own output.

    A checkpoint without a committed batch takes the ids stored by others, and those of
    `existing`, as its first state: this one time the store is read. Pages and ids
    that are NULL show nothing.
    """
    spark = pages.sparkSession
    counts = item_counts(pages, ids, page, id_name)
    page_type, id_type = (dict(counts.dtypes)[c] for c in ("_page", id_name))
    counts = counts.where("_page IS NOT NULL").select(id_name, "_page", "_n")
    shown = counts.mapInArrow(_firsts, f"`{id_name}` {id_type}, _page {page_type}, _n INT")
    known = None if _committed(spark, checkpoint) else _known(spark, store, checkpoint, id_name, existing, shown.schema[id_name].dataType)
    found = shown.groupBy(id_name).transformWithState(
        FirstSeen(), shown.schema, "Append", "None", None if known is None else known.groupBy(id_name)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        run = _run(spark, checkpoint)
        new = batch.select(id_name, F.col("_page").alias(page), F.explode(F.sequence(F.lit(1), "_n"))).drop("col")
        new.write.mode("overwrite").parquet(f"{store}/run={run}/batch_id={batch_id}")

    with keyed_state(spark):
        return _run_available(found, write, checkpoint)


def _known(spark: SparkSession, store: str, checkpoint: str, id_name: str, existing: DataFrame | None, kind: T.DataType) -> DataFrame | None:
    """The ids that others stored; None where there is none."""
    stored = read_store(spark, store)
    if stored is not None:
        # What a first batch of this checkpoint wrote before it failed is its own.
        stored = stored.where(F.col("run") != F.lit(_run(spark, checkpoint) or ""))
    known = [df.select(F.col(id_name).cast(kind).alias(id_name)) for df in (stored, existing) if df is not None]
    if not known:
        return None
    both = known[0] if len(known) == 1 else known[0].unionAll(known[1])
    return both.where(F.col(id_name).isNotNull()).distinct()


def _run(spark: SparkSession, checkpoint: str) -> str | None:
    """The checkpoint's id; None before its first start."""
    row = load_or_empty(spark, lambda: spark.read.schema("id STRING").json(f"{checkpoint}/metadata"), "id STRING").first()
    return None if row is None else row["id"]


def _committed(spark: SparkSession, checkpoint: str) -> bool:
    lines = load_or_empty(spark, lambda: spark.read.text(f"{checkpoint}/commits"), "value STRING")
    return not lines.isEmpty()


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """What is stored, with its run and batch; None before the first batch."""
    try:
        return spark.read.parquet(store).withColumn("run", F.col("run").cast("string"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _run_available(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process what is there in micro-batches, then stop; a restart goes on from it."""
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
