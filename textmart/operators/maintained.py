"""Exact distinct counts per group that are kept up to date from batch to batch.

The state holds, for each group and each stretch of 32,768 entity numbers, a bitmap of the
entities that are in the group. A batch names the entities it touches and the groups
that each of them has now: their bits are cleared everywhere and set where they belong,
so changed and removed children are counted right, without counts for each pair. Bitmaps of
different stretches are different rows: no group, however large, lies in one task.

A batch appends the bitmaps of the stretches it touches and a commit row; reading takes
the latest of each group and stretch. So the work of a batch follows the stretches that
its entities lie in. `compact` writes the state anew now and then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from textmart.operators.model import latest
from textmart.sizes import broadcast_if_small
from textmart.sources.read import load_or_empty

STRETCH = 32_768
WORD = 64
# So many bitmaps are worked on at once in a task.
BITMAPS = 512
_STATE = "grp STRING, stretch LONG, bits BINARY"
_COMMIT = "kind STRING, batch_id LONG"
# The group of all entities that are in some group.
ALL = "\u0000all"


def bitmaps(pairs: DataFrame, *keys: str) -> DataFrame:
    """One bitmap of 4,096 bytes for each value of the keys and each stretch of column `entity`.

    The bits are or-ed in words of 64 first, in a hash table before the shuffle: no row is
    sorted, and a bitmap is put together from 512 words at most.
    """
    place = pairs.select(
        *keys,
        F.floor(F.col("entity") / STRETCH).alias("stretch"),
        F.expr(f"CAST(pmod(entity, {STRETCH}) DIV {WORD} AS INT)").alias("word"),
        F.expr(f"shiftleft(1L, CAST(pmod(entity, {WORD}) AS INT))").alias("bit"),
    )
    words = place.groupBy(*keys, "stretch", "word").agg(F.bit_or("bit").alias("bits"))
    lists = words.groupBy(*keys, "stretch").agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    schema = StructType([*lists.schema[:-1], StructField("bits", BinaryType())])
    return lists.mapInArrow(_assembled, schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few bitmaps at a time, whatever the size of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, BITMAPS):
            yield batch.slice(at, BITMAPS)


def _rows(bits: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in bits], pa.binary())


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(keys, stretch, list of (word, bits)) to (keys, stretch, bitmap): bit n of a bitmap is bit n % 8 of byte n // 8."""
    for batch in _parts(batches):
        words = batch.column("words")
        row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
        word, bits = (x.to_numpy() for x in words.flatten().flatten())
        out = np.zeros((len(words), STRETCH // WORD), "<i8")
        out[row, word] = bits
        yield pa.record_batch([*batch.columns[:-1], _rows(out)], names=[*batch.schema.names[:-1], "bits"])


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, stretch, old, touched, new) to (grp, stretch, old without touched, with those of new that are touched)."""
    for batch in _parts(batches):
        old, touched, new = (
            np.frombuffer(b"".join(b if b is not None else bytes(STRETCH // 8) for b in batch.column(c).to_pylist()), np.uint8)
            for c in ("old", "touched", "new")
        )
        now = ((old & ~touched) | (new & touched)).reshape(batch.num_rows, -1)
        yield pa.record_batch([batch.column("grp"), batch.column("stretch"), _rows(now)], names=["grp", "stretch", "bits"])


def apply_batch(store: str, batch_id: int, touched: DataFrame, pairs: DataFrame, group: str, entity: str) -> None:
    """Bring the state up to date: every entity of `touched` is now in the groups that `pairs` gives it, and no other.

    Entities are whole numbers from 0; `pairs` of entities that are not touched, NULL groups and NULL
    entities play no part. Batches are numbered upwards; one that is committed is not
    applied again. Bits of entities that are not touched are left out where bitmaps meet; rows meet nowhere.
    `touched` is read twice: store it first if it is costly.
    """
    spark = touched.sparkSession
    if not _commits(spark, store).where((F.col("kind") == "batch") & (F.col("batch_id") == batch_id)).isEmpty():
        return
    named = touched.select(F.col(entity).cast("long").alias("entity")).where("entity IS NOT NULL")
    given = pairs.select(F.col(group).cast("string").alias("grp"), F.col(entity).cast("long").alias("entity"))
    given = given.where("grp IS NOT NULL AND entity IS NOT NULL")
    given = given.select(F.explode(F.array("grp", F.lit(ALL))).alias("grp"), "entity")
    cleared = bitmaps(named).withColumnRenamed("bits", "touched")
    fresh = bitmaps(given, "grp").withColumnRenamed("bits", "new")
    before = state(spark, store).withColumnRenamed("bits", "old")
    before = before.join(cleared.select("stretch"), "stretch", "left_semi")
    met = before.join(fresh, ["grp", "stretch"], "full").join(cleared, "stretch")
    changed = met.select("grp", "stretch", "old", "touched", "new").mapInArrow(_replaced, _STATE)
    changed.write.mode("overwrite").parquet(f"{store}/changes/batch_id={batch_id}")
    _commit(spark, store, "batch", batch_id)


def state(spark: SparkSession, store: str) -> DataFrame:
    """(grp, stretch, bits) as of the last committed batch."""
    commits = _commits(spark, store)
    upto = commits.where("kind = 'snapshot'").agg(F.max("batch_id")).first()[0]
    upto = -1 if upto is None else upto
    made = commits.where((F.col("kind") == "batch") & (F.col("batch_id") > upto)).select("batch_id").distinct()
    read = load_or_empty(
        spark, lambda: spark.read.schema(f"{_STATE}, batch_id LONG").option("basePath", f"{store}/changes").parquet(f"{store}/changes"),
        f"{_STATE}, batch_id LONG",
    )
    rows = read.join(broadcast_if_small(made), "batch_id", "left_semi").select("grp", "stretch", "bits", "batch_id")
    if upto >= 0:
        base = spark.read.schema(_STATE).parquet(f"{store}/snapshot-{upto}")
        rows = rows.unionByName(base.withColumn("batch_id", F.lit(upto)))
    return latest(rows, ["grp", "stretch"], "batch_id").select("grp", "stretch", "bits")


def compact(spark: SparkSession, store: str) -> None:
    """Write the state as of the last batch; older changes are no longer read."""
    last = _commits(spark, store).groupBy("kind").agg(F.max("batch_id").alias("n")).collect()
    last = {r.kind: r.n for r in last}
    if last.get("batch", -1) <= last.get("snapshot", -1):
        return
    state(spark, store).where(F.bitmap_count("bits") > 0).write.mode("overwrite").parquet(f"{store}/snapshot-{last['batch']}")
    _commit(spark, store, "snapshot", last["batch"])


def counts(spark: SparkSession, store: str, group: str = "grp", out: str = "n") -> DataFrame:
    """(group, distinct entities) of each group that has any."""
    sums = state(spark, store).where(F.col("grp") != ALL).groupBy("grp").agg(F.sum(F.bitmap_count("bits")).alias(out))
    return sums.where(F.col(out) > 0).select(F.col("grp").alias(group), out)


def total(spark: SparkSession, store: str) -> int:
    """Distinct entities that are in some group."""
    return state(spark, store).where(F.col("grp") == ALL).agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0


def _commit(spark: SparkSession, store: str, kind: str, batch_id: int) -> None:
    spark.createDataFrame([(kind, batch_id)], _COMMIT).coalesce(1).write.mode("append").json(f"{store}/commits")


def _commits(spark: SparkSession, store: str) -> DataFrame:
    return load_or_empty(spark, lambda: spark.read.schema(_COMMIT).json(f"{store}/commits"), _COMMIT)
