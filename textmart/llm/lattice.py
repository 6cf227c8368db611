"""Near-duplicate vectors by hashing to E8 lattice points.

Each of TABLES tables projects the unit vectors to eight dimensions by a random
orthonormal map of its own, scales them and takes the nearest point of the lattice E8:
the vector's home cell. It also visits the PROBES neighbouring cells whose points are
nearest among the 240 shortest lattice vectors away. Two vectors meet in a cell if it
is home to one and the other is at home in it or visits it. Those that meet are compared
by cosine in double precision.

Equal vectors are compared once and counted as often as they occur. A cell is compared
in blocks of at most BLOCK vectors, each pair of blocks by one matrix product, so a
crowded cell is spread over tasks. A pair that meets more than once counts in the first
table and cell it meets in, which each block can tell from the two vectors' cells. A
block gives sums and one link per vector to its part of the block's components, so no
list of pairs is made.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite components
link with nothing. Vectors of different lengths link with nothing. Rows of one id are
one node: their links are added up. A row with a null id links with nothing and has no
component. An empty table gives no rows.

Not every pair is certain to meet: see the README for the measured share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import by_value, local_components, mixed, runs, written
from textmart.llm.components import components

TABLES, PROBES, SCALE = 8, 3, 2.0
BLOCK = 512
SEED = 20_000


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum."""
    near = np.rint(x)
    rest = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(rest[odd]).argmax(axis=1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8, or D8 moved by one half in each coordinate."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def shortest_vectors() -> np.ndarray:
    """The 240 lattice vectors of squared length 2."""
    out = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a in (-1.0, 1.0):
                for b in (-1.0, 1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    signs = 1 - 2 * ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
    even = (signs < 0).sum(axis=1) % 2 == 0
    return np.vstack([np.array(out), signs[even] / 2])


def point_keys(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key of each lattice point of a table."""
    key = np.full(points.shape[:-1], table, np.uint64)
    for i in range(8):
        key = mixed(key, np.rint(points[..., i] * 2).astype(np.int64).view(np.uint64))
    return key


def cell_keys(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """(vectors, tables, 1 + probes) keys: the home cell, then the cells visited."""
    n, width = unit.shape
    around = shortest_vectors()
    lengths = (around**2).sum(axis=1)
    out = np.empty((n, tables, 1 + probes), np.uint64)
    for t in range(tables):
        random = np.random.default_rng(SEED + t).standard_normal((max(width, 8), 8))[: max(width, 8)]
        axes = np.linalg.qr(random)[0][:width]
        x = unit @ axes * (scale * np.sqrt(max(width, 8) / 8))
        home = nearest_e8(x)
        # |x - home - v|^2 = |x - home|^2 - 2 (x - home).v + |v|^2
        apart = lengths[None, :] - 2 * (x - home) @ around.T
        near = np.argpartition(apart, probes - 1, axis=1)[:, :probes] if probes else np.zeros((n, 0), int)
        out[:, t, 0] = point_keys(home, t)
        out[:, t, 1:] = point_keys(home[:, None, :] + around[near], t)
    return out


def vector_nodes(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """Distinct usable vectors: (vector, node = smallest id, times)."""
    picked = rows.select(F.col(id).cast("long").alias("node"), F.col(vector).cast("array<double>").alias("vector"))
    fine = picked.where(
        F.col("node").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0.0)
    )
    return fine.groupBy("vector").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("times"))


def block_links(table: pa.Table, tables: int, probes: int, least: float) -> tuple[np.ndarray, ...]:
    """Links of all groups (cell, block of the home side, block of the other side) of a table:
    (node, links to add), and (node, node) links that join each group's components."""
    nodes, times = table.column("node").to_numpy(), table.column("times").to_numpy()
    home, left, right = (table.column(c).to_numpy(zero_copy_only=False) for c in ("home", "left", "right"))
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64).reshape(-1, tables, 1 + probes)
    raw = table.column("vector").to_pylist()
    cell = table.column("cell").to_numpy()
    widths = np.fromiter(map(len, raw), np.int64, len(raw))
    change = (cell[1:] != cell[:-1]) | (table.column("i").to_numpy()[1:] != table.column("i").to_numpy()[:-1]) | (table.column("j").to_numpy()[1:] != table.column("j").to_numpy()[:-1])
    starts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(nodes)]])
    counted, summed, joined = [], [], []
    for low, high in zip(starts, starts[1:]):
        for width in np.unique(widths[low:high]):
            at = low + np.flatnonzero(widths[low:high] == width)
            a, b = at[left[at]], at[right[at]]
            if len(at) < 2 or not len(a) or not len(b):
                continue
            t = int(np.flatnonzero((keys[a[0], :, 0] == cell[low].view(np.uint64)))[0])
            x, y = (np.frombuffer(b"".join(raw[i] for i in s), np.float64).reshape(len(s), -1) for s in (a, b))
            close = x @ y.T >= least - 1e-9
            i, j = np.nonzero(close)
            if not len(i):
                continue
            p, q = a[i], b[j]
            # Two at home meet in one order only.
            keep = (nodes[p] != nodes[q]) & (~home[q] | (nodes[p] < nodes[q]))
            p, q, i, j = p[keep], q[keep], i[keep], j[keep]
            # Cosines once more, in a fixed order of additions.
            keep = np.einsum("ij,ij->i", x[i], y[j]) >= least
            p, q = p[keep], q[keep]
            keep = np.ones(len(p), bool)
            for u in range(t + 1):
                p_home, q_home = keys[p, u, 0], keys[q, u, 0]
                q_visits = (keys[q, u, 1:] == p_home[:, None]).any(axis=1)
                p_visits = (keys[p, u, 1:] == q_home[:, None]).any(axis=1)
                if u < t:
                    keep &= ~((p_home == q_home) | q_visits | p_visits)
                else:  # each visits the other's home: the lower key's cell counts
                    keep &= (p_home == q_home) | ~p_visits | (p_home < q_home)
            p, q = p[keep], q[keep]
            if not len(p):
                continue
            members, at_ = np.unique(np.concatenate([p, q]), return_inverse=True)
            half = len(p)
            counted.append(nodes[members])
            summed.append(np.bincount(at_, np.concatenate([times[q], times[p]]), minlength=len(members)).astype(np.int64))
            root = local_components(len(members), at_[:half], at_[half:])
            joined.append(np.column_stack([nodes[members], nodes[members[root]]]))
    if not counted:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    return np.concatenate(counted), np.concatenate(summed), np.concatenate(joined)


def linked_vectors(rows: DataFrame, least: float = 0.9, id: str = "vec_id", vector: str = "embedding", tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(id, n_links, component_id, kept) of each row."""
    distinct = written(vector_nodes(rows, id, vector), "vectors")

    def hash_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for width in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == width)
                x = flat[starts[at][:, None] + np.arange(width)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large components overflow
                unit = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
                keys = cell_keys(unit, tables, probes, scale)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([
                    part.column("node"), part.column("times"),
                    pa.array([u.tobytes() for u in unit], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array(keys[:, :, 0].astype(np.int64).tolist(), pa.list_(pa.int64())), pa.array(keys[:, :, 1:].reshape(len(at), -1).astype(np.int64).tolist(), pa.list_(pa.int64())),
                ], names=["node", "times", "vector", "keys", "homes", "visits"])

    hashed = written(distinct.mapInArrow(by_value(hash_cells), "node long, times long, vector binary, keys binary, homes array<long>, visits array<long>"), "cells")
    at_home = hashed.select("node", F.explode("homes").alias("cell"), F.lit(True).alias("home"))
    visiting = hashed.select("node", F.explode("visits").alias("cell"), F.lit(False).alias("home"))
    entries = at_home.unionAll(visiting)
    crowds = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.count_if("home").alias("at_home")).where("size > 1 and at_home > 0")
    crowds = crowds.select("cell", F.ceil(F.col("at_home") / BLOCK).cast("int").alias("lefts"), F.ceil(F.col("size") / BLOCK).cast("int").alias("rights"))
    salt = F.abs(F.xxhash64("node"))
    met = entries.join(crowds, "cell").select(
        "cell", "node", "home", F.when(F.col("home"), (salt % F.col("lefts")).cast("int")).alias("i"),
        (F.abs(F.xxhash64("node", F.lit(1))) % F.col("rights")).cast("int").alias("j"), "lefts", "rights",
    )
    # A vector at home faces every block of the other side, and as one of that side every block at home.
    faced = F.array_union(
        F.when(F.col("home"), F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda j: F.struct(F.col("i").alias("i"), j.alias("j")))).otherwise(F.array().cast("array<struct<i:int,j:int>>")),
        F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: F.struct(i.alias("i"), F.col("j").alias("j"))),
    )
    spread = met.select("cell", "node", "home", F.col("i").alias("own_i"), F.col("j").alias("own_j"), F.explode(faced).alias("at"))
    spread = spread.select(
        "cell", "node", "home", "at.i", "at.j",
        (F.col("home") & (F.col("own_i") == F.col("at.i"))).alias("left"), (F.col("own_j") == F.col("at.j")).alias("right"),
    )
    loaded = spread.join(hashed.select("node", "times", "vector", "keys"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["cell", "i", "j"], 4000):
            nodes, sums, joined = block_links(table, tables, probes, least)
            for low in range(0, len(nodes), 10_000):
                part = slice(low, low + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(sums[part]), pa.array(joined[part, 1])], names=["node", "links", "root"])

    ordered = loaded.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "node")
    found = written(ordered.mapInArrow(by_value(compare), "node long, links long, root long"), "links")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    lowest = components(found, "node", "root").withColumnRenamed("id", "node")
    counted = distinct.join(sums, "node", "left").join(lowest, "node", "left")
    counted = counted.select("vector", "node", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    keyed = rows.select(F.col(id), F.col(vector).cast("array<double>").alias("vector"))
    out = keyed.join(counted, "vector", "left").select(
        id, F.when(F.col(id).isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col(id).isNotNull(), F.coalesce("component", F.col(id).cast("long"))).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))
