"""Size checks in front of everything that is broadcast or held as a literal.

Dictionaries and rules are hand-written and small, but nothing forces them to
stay so. Each user of these helpers has another way for the case "too big".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# A rule table up to this many rows becomes literals of the plan.
MAX_LITERAL_ROWS = 5_000
# A lookup table up to this many (narrow) rows gets a broadcast hint.
MAX_BROADCAST_ROWS = 200_000
# Narrow rows dealt to one task that keeps them in a hash table.
ROWS_PER_TASK = 500_000


def collect_if_small(df: DataFrame, limit: int = MAX_LITERAL_ROWS) -> list[Row] | None:
    """The rows, or None if there are more than `limit` of them."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def is_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan of fewer splits than cores one task per core.

    Text work costs far more than moving the text, so a small input in one file is
    worth a shuffle. A large one has more splits than cores and is left alone. Use
    it on scans only.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the row count is checked; else leave it to AQE."""
    return F.broadcast(df) if is_small(df, limit) else df


def dealt(df: DataFrame, *keys: str, beside: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Deal narrow rows by their keys, so many to a task, for a hash table on them.

    AQE merges partitions up to a number of compressed bytes, which may be ten million narrow
    rows in one task. Use it on keys that no large share of the rows has in common. The
    rows, and those of a frame to be joined on the keys, are counted first: store them if they are costly.
    """
    n = df.count() + (beside.count() if beside is not None else 0)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // (rows or ROWS_PER_TASK))), *keys)


def looked_up(keys: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Distinct keys as the right side of a semi or anti join: a broadcast if few, else a hash table for each partition.

    The left side streams past them and is not sorted; its hot keys are still split by AQE.
    """
    return F.broadcast(keys) if is_small(keys, limit) else keys.hint("shuffle_hash")
