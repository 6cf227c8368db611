"""What several operators share: words of a text, stable row numbers, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from textmart.session import scratch_path

# Bytes of text held at once by a task; longer batches are cut between rows.
CHUNK_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few MB at a time; Spark's own setting is up to 10,000 rows.

    A batch lies in memory outside the heap on both sides, for each task of an executor.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, stored once in the shared scratch folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size of the files a scan reads; used for partition counts only."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def arrow_texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Large strings without nulls (null: empty), in memory of their own.

    Arrow's string functions misread slices that were cast to large strings.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    copied = pa.concat_arrays([column.cast(pa.large_string()), pa.array([], pa.large_string())])
    return pc.fill_null(copied, "")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; one row may exceed it alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit, prepend=0)) if len(sizes) else []
        edges = [0, *[c for c in cuts if c], batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                yield batch.slice(low, high - low)
        pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Neighbouring small batches joined to tables of about `limit` bytes of text."""
    held, size = [], 0
    for batch in slices(batches, column, limit):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held)


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of lower-cased (A-Z only) texts.

    Returns the position in `vocabulary` of each word of each text, one after the
    other; the distinct words; and each text's first word (one more than texts).
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten() if len(lists) else pa.array([], pa.large_string())
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    # Leading and trailing white space leave empty strings.
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])
    coded = flat.filter(pa.array(full)).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, kept[offsets]


def hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxhash of each string."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit value of two, order counting; a bijection in b for a fixed a."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n places and links between places a and b: the smallest place reachable from each."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            next_label = label[label]
            if (next_label == label).all():
                break
            label = next_label
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], step: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups: rows sorted by `keys` come in, and no group is cut between two tables.

    A table has the rows of many small groups, or one larger group.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def last_start(table: pa.Table) -> int:
        start = 0
        for key in keys:
            values = table.column(key).to_numpy()
            change = np.flatnonzero(values[1:] != values[:-1])
            start = max(start, int(change[-1]) + 1 if len(change) else 0)
        return start

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= step:
            table = pa.Table.from_batches(held)
            cut = last_start(table)
            if cut:
                yield table.slice(0, cut)
                pa.default_memory_pool().release_unused()
            held = table.slice(cut).combine_chunks().to_batches()
            size = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


class RowNumbers:
    """Numbers no other row of the stage has: the task's partition, then a count.

    A task that is run again reads the same split and gives the same numbers.
    """

    def __init__(self) -> None:
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 40

    def take(self, n: int) -> np.ndarray:
        self.next += n
        return np.arange(self.next - n, self.next, dtype=np.int64)


def by_value(function: Callable) -> Callable:
    """Ship this package's code with the function, so that executors need not have it installed."""
    import textmart.llm
    import textmart.sources.files
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(textmart.llm)
    cloudpickle.register_pickle_by_value(textmart.sources.files)
    return function
