"""Connected components of a stored set of links, by alternating star contractions.

A large-star round links the larger neighbours of every node to its smallest
neighbour; a small-star round links the smaller ones (and the node) to it. Components
do not change, and in the end every node is linked to the smallest of its component.
Each round is stored in the shared folder. Only minima are gathered per node, never
its neighbours, so a node with many links makes no large row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import written


def _linked(links: DataFrame) -> DataFrame:
    """Links (a, b) with a > b, each once."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    # small star: links as they are (a > b); large star: both ways.
    around = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    lowest = around.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    if large:
        # Node a has the smallest neighbour (or itself) low: its larger neighbours b link to low.
        met = around.where("b > a").join(lowest, "a")
        return _linked(met.select(F.col("b").alias("a"), F.col("low").alias("b")))
    met = links.join(lowest, "a")
    return _linked(met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(lowest.select("a", F.col("low").alias("b"))))


def _state(links: DataFrame) -> tuple:
    # Sums of hashes as decimals: no overflow.
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each linked node but the smallest of its component, and that smallest one.

    Links of a node to itself and repeated links are harmless; null ends are dropped.
    """
    kept = written(_linked(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    state = _state(kept)
    while True:
        kept = written(_star(_star(kept, True), False), "links")
        now = _state(kept)
        if now == state:
            return kept.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = now
