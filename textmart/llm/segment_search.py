"""Exact top-k by inner product, with bounds from segment statistics.

A vector is cut into segments. With the mean m and the root s of the squared
deviations of each segment, two vectors' product is at most
sum over segments of (width * m * m' + s * s'), and likewise their squared distance at
least sum of (width * (m - m')^2 + (s - s')^2). The bound is taken with 1, 4 and 16
segments in turn, each for the pairs that the one before left: pairs that stay below the query's
k-th best score so far are out. Those left get their exact score. A task keeps each query's
k best scores over all blocks that it sees.

Queries are a stated set, held in blocks of at most BLOCK vectors; a block of
candidates meets one block of queries at a time, both as matrices, and gives back k
rows per query at most. Blocks of queries are sent to the tasks in groups of GROUP; with several
groups, each one's rows are stored before the next, so that the plan stays small.

Defined cases: vectors that are null or hold null or non-finite components take no
part, nor do those with a component whose multiple leaves double precision; scores must fit
in 64 bits. Only vectors of equal length are compared (empty ones score 0). A repeated id is
a candidate for every row with another id; rows with the query's own id are not. Ties
go to the smaller id. Rows that share a query's id ask together. A query with fewer than k candidates gets all of them. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.llm.common import by_value, written
from textmart.session import scratch_path

BLOCK = 1024
GROUP = 32
LEVELS = (1, 4, 16)
# Pairs that are looked at one by one at a time; and from which share of all pairs on they are.
STEP = 1 << 16
DENSE = 32
# Below this every sum of products is exact in double precision.
EXACT = float(1 << 53)


def block_schema() -> str:
    return "block long, size long, width int, ids binary, parts binary"


def pack(rows: DataFrame, id: str, vector: str, scale: float) -> DataFrame:
    """Blocks of at most BLOCK vectors of one length: ids, and floor(scale * x) as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def full(width: int) -> pa.RecordBatch:
            ids, parts = held.pop(width)
            ids, parts = np.concatenate(ids), np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([parts.tobytes()], pa.binary())],
                names=["block", "size", "width", "ids", "parts"],
            )

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            for width in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == width)
                parts = np.floor(flat[(starts[at][:, None] + np.arange(width)).ravel()] * scale).reshape(len(at), width)
                fine = np.isfinite(parts).all(axis=1)
                at, parts = ids[at][fine], parts[fine]
                for low in range(0, len(at), BLOCK):
                    mine = held.setdefault(width, ([], []))
                    mine[0].append(at[low : low + BLOCK])
                    mine[1].append(parts[low : low + BLOCK])
                    if sum(map(len, mine[0])) >= BLOCK:
                        yield full(width)
        for width in list(held):
            yield full(width)

    picked = rows.select(F.col(id).cast("long"), F.col(vector).cast("array<double>")).where(F.col(id).isNotNull() & F.col(vector).isNotNull())
    return picked.mapInArrow(by_value(run), block_schema())


def statistics(parts: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per vector and segment: sqrt(width) * mean, and the root of the summed squared deviations."""
    n, width = parts.shape
    pieces = np.array_split(np.arange(width), min(segments, max(width, 1)))
    means, roots = np.zeros((n, len(pieces))), np.zeros((n, len(pieces)))
    for j, piece in enumerate(pieces):
        if len(piece):
            x = parts[:, piece]
            m = x.mean(axis=1)
            means[:, j] = m * np.sqrt(len(piece))
            roots[:, j] = np.sqrt(((x - m[:, None]) ** 2).sum(axis=1))
    return means, roots


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers, as 64-bit integers."""
    if not a.size or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))


def survivor_scores(q: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray, step: int = STEP) -> np.ndarray:
    """Exact scores of the pairs, a bounded number at a time."""
    parts = [exact_scores(q[rows[i : i + step]], c[cols[i : i + step]]) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def bounds(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray], pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Upper bounds from the statistics, of all pairs as a matrix or of the given ones; widened by what rounding may cost."""
    (qm, qs), (cm, cs) = q, c
    if pairs is None:
        spread = qs @ cs.T
        return qm @ cm.T + spread + 1e-9 * (np.abs(qm) @ np.abs(cm).T + spread) + 1e-6
    (rows, cols), out = pairs, np.empty(len(pairs[0]))
    for low in range(0, len(rows), STEP):
        a, b = rows[low : low + STEP], cols[low : low + STEP]
        spread = np.einsum("ij,ij->i", qs[a], cs[b])
        out[low : low + STEP] = np.einsum("ij,ij->i", qm[a], cm[b]) + spread + 1e-9 * (np.einsum("ij,ij->i", np.abs(qm[a]), np.abs(cm[b])) + spread) + 1e-6
    return out


def survivors(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs whose bounds reach the query's floor, coarse to fine; the floors rise on the way."""
    n, m = len(q), len(c)
    bound = bounds(statistics(q, LEVELS[0]), statistics(c, LEVELS[0]))
    alive = q_ids[:, None] != c_ids[None, :]
    bound[~alive] = -np.inf
    if m >= k:
        # Exact scores of the k candidates with the highest coarse bounds.
        top = np.argpartition(-bound, k - 1, axis=1)[:, :k]
        at = np.repeat(np.arange(n), k)
        scores = exact_scores(q[at], c[top.ravel()]).astype(np.float64)
        scores[~alive[at, top.ravel()]] = -np.inf
        np.maximum(floor, scores.reshape(n, k).min(axis=1), out=floor)
    rows, cols = np.nonzero(alive & (bound >= floor[:, None]))
    for segments in LEVELS[1:]:
        if not len(rows):
            break
        # Queries and candidates without a pair left take no further part.
        mine, rows = np.unique(rows, return_inverse=True)
        its, cols = np.unique(cols, return_inverse=True)
        pieces = statistics(q[mine], segments), statistics(c[its], segments)
        if len(rows) * DENSE < len(mine) * len(its):
            keep = bounds(*pieces, (rows, cols)) >= floor[mine[rows]]
        else:
            # Where many are left, one product of matrices takes less than their pairs do.
            keep = bounds(*pieces)[rows, cols] >= floor[mine[rows]]
        rows, cols = mine[rows[keep]], its[cols[keep]]
    return rows, cols


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, best: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of each query's k best in one block.

    `best` holds the k highest scores of each query in earlier blocks (-inf for none): what stays
    below the lowest of them is left out, and this block's scores are entered.
    """
    best = np.full((len(q), k), -np.inf) if best is None else best
    rows, cols = survivors(q_ids, q, c_ids, c, k, best.min(axis=1))
    scores = survivor_scores(q, c, rows, cols)
    order = np.lexsort((c_ids[cols], -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    keep = rank < k
    rows, cols, scores, rank = rows[keep], cols[keep], scores[keep], rank[keep]
    here = np.full_like(best, -np.inf)
    # Rounded down, so that a floor never lies above a score.
    here[rows, rank] = np.nextafter(scores.astype(np.float64), -np.inf)
    best[:] = -np.sort(-np.hstack([best, here]), axis=1)[:, :k]
    return rows, cols, scores


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest scores of each query."""
    spark = rows.sparkSession
    asked = pack(queries, id, vector, scale)
    # Number the blocks, so that they can be taken a bounded group at a time.
    asked = written(asked.withColumn("block", F.monotonically_increasing_id()), "queries")
    numbers = sorted(r.block for r in asked.select("block").collect())  # one per BLOCK queries
    blocks = written(pack(rows, id, vector, scale), "vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # k scores for each query of the group.
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q_parts"], np.float64).reshape(len(q_ids), row["width"])
                c = np.frombuffer(row["parts"], np.float64).reshape(len(c_ids), row["width"])
                so_far = best.setdefault(row["q_block"], np.full((len(q), k), -np.inf))
                a, b, scores = best_of_block(q_ids, q, c_ids, c, k, so_far)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(c_ids[b]), pa.array(scores)], names=["query_id", id, "score"])

    found, paths = None, []
    for low in range(0, len(numbers), GROUP):
        span = asked.where(F.col("block").between(numbers[low], numbers[min(low + GROUP, len(numbers)) - 1]))
        # At most GROUP blocks, so BLOCK * GROUP vectors.
        span = F.broadcast(span.select("width", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("parts").alias("q_parts")))
        part = blocks.join(span, "width").select("width", "ids", "parts", "q_block", "q_ids", "q_parts").mapInArrow(by_value(run), f"query_id long, {id} long, score long")
        if len(numbers) > GROUP:
            paths.append(scratch_path(spark, "found"))
            part.write.parquet(paths[-1])
        found = part
    if found is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id} long, score long")
    if paths:
        found = spark.read.schema(found.schema).parquet(*paths)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", id, "score")
