"""Near-duplicate texts by bottom-k sketches of one hash function.

A text's set holds its distinct five-word shingles as 64-bit hashes; its sketch the
SKETCH lowest of them. Two texts are linked if 100 * intersection >= 75 * union.

1. Texts with equal sets form a class.
2. The sketches' values are inverted. A value that more than FREQUENT classes retain
   tells little (a passage that many texts share). A class is listed under its LIGHT
   lowest other values; one whose sketch is mostly such frequent values (a large group
   of copies, or little but a common passage) also under its HEAVY lowest frequent ones.
3. In each list, in blocks of at most BLOCK classes, sketches are compared: below the
   lower of two sketches' ends both are complete, so the shares of that part estimate
   the Jaccard similarity of the sets (the union's sketch). A block gives one link per
   class to its part of the block's components, never pairs. Their components are the
   clusters, of sets that may be linked.
4. In each cluster, again in blocks, the full sets of all pairs that pass the estimate
   are intersected, exactly. The blocks' components are joined to the final ones.

Each class's full set is sent once to each block pair of its cluster, so once in a
cluster of up to BLOCK classes. A crowded list or cluster is spread by its blocks.

How sure: texts with similarity 0.75 share each value of their union's sketch with
probability 0.75 or more. If less than half of a sketch is frequent, at least half of
its other values are shared, so a list misses with 2^-LIGHT at the limit of 0.75 and
rapidly less above it; a mostly frequent pair with 4^-HEAVY. The estimate's threshold
is five standard deviations below 0.75.

Defined cases: a text of one to four words has one shingle, all its words. A null or
empty text, or one of white space, has an empty set and links with nothing. Rows of one
id are one text each, but one node: what any of its texts is linked with is one component.
A row without an id links with nothing. Repeated rows link as copies. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from textmart.llm.common import arrow_texts, ascii_words, by_value, gathered, hashes, local_components, mixed, runs, written
from textmart.llm.components import components

WORDS = 5
SKETCH = 64
LIGHT, HEAVY, FREQUENT = 16, 10, 64
BLOCK = 512
ESTIMATE = 0.48
# A text with more than one in so many rows is one of few.
COMMON = 2000
COLUMNS = 4096  # shingles of a block that are intersected at once


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    index, vocabulary, first = ascii_words(texts)
    names = hashes(vocabulary)
    every = names[index] if len(index) else np.zeros(0, np.uint64)
    for low, high in zip(first, first[1:]):
        text = every[low:high]
        n = min(words, len(text))
        # Fewer words: one shingle of them all, told apart by its length.
        shingle = np.full(max(len(text) - words + 1, min(n, 1)), n, np.uint64)
        for j in range(n):
            shingle = mixed(shingle, text[j : j + len(shingle)])
        yield np.unique(shingle)


def sketches(docs: DataFrame, key: str, text: str, words: int, size: int) -> DataFrame:
    """(id, n_shingles, content: digest of the set or null, sketch: the lowest values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "_text"):
            sets = list(shingle_sets(arrow_texts(table.column("_text")), words))
            yield pa.RecordBatch.from_arrays([
                table.column("_key").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([(s[:size] ^ np.uint64(1 << 63)).view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], names=["id", "n_shingles", "content", "sketch"])

    picked = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    return picked.mapInArrow(by_value(run), "id long, n_shingles long, content binary, sketch array<long>")


def listed(classes: DataFrame, frequent: int, light: int, heavy: int) -> DataFrame:
    """(cell, id): the lists each class is in, of those with two or more classes."""
    values = classes.select("id", F.size("sketch").alias("length"), F.explode("sketch").alias("cell"))
    shared = values.groupBy("cell").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    marked = values.join(shared, "cell").select("id", "length", F.struct((F.col("holders") > frequent).alias("often"), "cell").alias("v"))
    # At most a sketch of values per class.
    each = marked.groupBy("id").agg(F.first("length").alias("length"), F.sort_array(F.collect_list("v")).alias("vs"))
    rare, often = F.filter("vs", lambda v: ~v.often), F.filter("vs", lambda v: v.often)
    mostly = 2 * F.size(often) > F.col("length")
    used = F.concat(F.slice(rare, 1, light), F.when(mostly, F.slice(often, 1, heavy)).otherwise(F.slice(often, 1, 0)))
    return each.select("id", F.explode(F.transform(used, lambda v: v.cell)).alias("cell"))


def in_blocks(entries: DataFrame, block: int) -> DataFrame:
    """(cell, i, j, id, left, right): each member of a cell, for each pair i <= j of blocks it faces."""
    sizes = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    placed = entries.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = placed.select("cell", "id", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("own"))
    faced = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    spread = placed.select("cell", "id", "own", F.explode(faced).alias("at"))
    return spread.select("cell", "at.i", "at.j", "id", (F.col("own") == F.col("at.i")).alias("left"), (F.col("own") == F.col("at.j")).alias("right"))


def incidence(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """0/1 matrices (sets x values) of the values that two or more of the sets hold, some columns at a time."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    keep = times[at] > 1
    owner, at = owner[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], at[a:b] - low] = 1.0
        yield part


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at `left` with those at `right`."""
    out = np.zeros((len(left), len(right)), np.float64)
    for part in incidence(sets):
        out += part[left] @ part[right].T  # sums of at most COLUMNS ones: exact
    return out


def estimates(parts: list[np.ndarray], lengths: np.ndarray, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Similarity estimates from sketches; a sketch shorter than `size` is the whole set."""
    last = np.array([p[-1] if n >= size else np.iinfo(np.int64).max for p, n in zip(parts, lengths)])
    shared = common(parts, left, right)
    ends = np.minimum(last[left][:, None], last[right][None, :])
    below = lambda at, e: np.vstack([np.searchsorted(parts[i], row, "right") for i, row in zip(at, e)])
    union = below(left, ends) + below(right, ends.T).T - shared
    return shared / np.maximum(union, 1)


def group_starts(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows - 1, bool)
    for name in ("cell", "i", "j"):
        values = table.column(name).to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])


def joined(nodes: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(node, root) for the places p and q that are linked."""
    members, at = np.unique(np.concatenate([p, q]), return_inverse=True)
    root = local_components(len(members), at[: len(p)], at[len(p) :])
    return np.column_stack([nodes[members], nodes[members[root]]])


def block_roots(table: pa.Table, size: int, estimate: float, percent: int | None) -> np.ndarray:
    """(id, root) for each class that is linked in one of a table's block pairs: by estimate
    alone, or with `percent` by the full sets of those that pass the estimate."""
    nodes, left, right = (table.column(c).to_numpy(zero_copy_only=False) for c in ("id", "left", "right"))
    parts = [np.frombuffer(b, np.int64) for b in table.column("values").to_pylist()]
    found = []
    starts = group_starts(table)
    for low, high in zip(starts, starts[1:]):
        a, b = np.flatnonzero(left[low:high]), np.flatnonzero(right[low:high])
        if high - low < 2 or not len(a) or not len(b):
            continue
        mine = parts[low:high]
        lengths = np.array([len(p) for p in mine])
        near = estimates([p[:size] for p in mine], lengths, a, b, size) >= estimate
        near &= nodes[low:high][a][:, None] != nodes[low:high][b][None, :]
        if not near.any():
            continue
        if percent is not None:
            x, y = a[near.any(axis=1)], b[near.any(axis=0)]
            near = near[near.any(axis=1)][:, near.any(axis=0)]
            used = np.unique(np.concatenate([x, y]))
            shared = common([mine[i] for i in used], np.searchsorted(used, x), np.searchsorted(used, y))
            near &= 100 * shared >= percent * (lengths[x][:, None] + lengths[y][None, :] - shared)
            a, b = x, y
        i, j = np.nonzero(near)
        if len(i):
            found.append(joined(nodes[low:high], a[i], b[j]))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def compared(loaded: DataFrame, size: int, estimate: float, percent: int | None) -> DataFrame:
    """(id, root) links from all block pairs of (cell, i, j, id, left, right, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["cell", "i", "j"], 2000):
            roots = block_roots(table, size, estimate, percent)
            yield pa.RecordBatch.from_arrays([pa.array(roots[:, 0]), pa.array(roots[:, 1])], names=["id", "root"])

    ordered = loaded.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "id")
    return ordered.select("cell", "i", "j", "id", "left", "right", "values").mapInArrow(by_value(run), "id long, root long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = 75, sketch: int = SKETCH, light: int = LIGHT, heavy: int = HEAVY, frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row. `percent` is the least similarity."""
    docs = docs.select(F.col(key), F.col(text))
    sketched = written(sketches(docs, key, text, words, sketch), "sketches")
    full = sketched.where("content is not null and id is not null")
    # Classes have numbers of their own: an id may have several texts.
    standing = full.groupBy("content").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("sketch").alias("sketch"))
    standing = written(standing.withColumn("id", F.monotonically_increasing_id()), "classes")

    def packed_sketches(frame: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("sketch")
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                raw = [p.tobytes() for p in np.split(flat, np.cumsum(sizes)[:-1])] if len(sizes) else []
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary())], names=["id", "values"])

        return frame.select("id", "sketch").mapInArrow(by_value(run), "id long, values binary")

    lists = in_blocks(listed(standing, frequent, light, heavy), block)
    maybe = compared(lists.join(packed_sketches(standing), "id"), sketch, ESTIMATE, None)
    clusters = components(written(maybe, "maybe"), "id", "root")
    # The smallest member of each cluster has no row of its own there.
    members = clusters.select("id", F.col("component").alias("cell")).unionAll(clusters.select(F.col("component").alias("id"), F.col("component").alias("cell")).distinct())
    members = written(members, "clusters")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "_text"):
            found = list(shingle_sets(arrow_texts(table.column("_text")), words))
            digests = pa.array([xxh3_128_digest(s.tobytes()) for s in found], pa.binary())
            raw = pa.array([(s ^ np.uint64(1 << 63)).tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([digests, raw], names=["content", "values"])

    asked = written(members.select("id").join(standing.select("id", "least", "content"), "id"), "asked")
    wanted = docs.select(F.col(key).cast("long").alias("least"), F.col(text).alias("_text")).join(asked.select("least"), "least", "left_semi")
    full_sets = wanted.select("_text").mapInArrow(by_value(sets), "content binary, values binary").dropDuplicates(["content"])
    full_sets = full_sets.join(asked.select("id", "content"), "content").select("id", "values")
    exact = compared(in_blocks(members, block).join(full_sets, "id"), sketch, ESTIMATE, percent)
    final = components(written(exact, "exact"), "id", "root")
    of_class = standing.join(final, "id", "left").select("content", "n", "least", F.coalesce("component", "id").alias("component"))
    of_class = bridged(full, written(of_class, "components"))
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = written(of_class.join(least, "component").select("content", "n", "component_id"), "groups")
    out = with_class(sketched, of_class).select(F.col("id").alias(key), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def with_class(rows: DataFrame, of_class: DataFrame) -> DataFrame:
    """The rows with the columns of their class, by content.

    Classes with more than 1/COMMON of all rows, fewer than COMMON, are broadcast: no task gets their rows.
    """
    rows = rows.select("id", "n_shingles", "content")
    most = (of_class.agg(F.sum("n")).first()[0] or 0) / COMMON
    frequent = F.broadcast(of_class.where(F.col("n") > most).drop("n"))
    others = of_class.where(F.col("n") <= most).drop("n")
    left = rows.join(frequent.select("content"), "content", "left_anti")
    return rows.join(frequent, "content").unionByName(left.join(others, "content", "left"))


def bridged(full: DataFrame, of_class: DataFrame) -> DataFrame:
    """Classes with the components that share an id, through different texts of it, joined."""
    placed = with_class(full, of_class.select("content", "n", "component"))
    several = placed.groupBy("id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    several = written(several.select("id", "low"), "several")
    if several.isEmpty():
        return of_class
    links = placed.join(several, "id").select(F.col("component").alias("a"), F.col("low").alias("b")).distinct()
    met = components(written(links, "bridges")).select(F.col("id").alias("component"), F.col("component").alias("joined"))
    return written(of_class.join(met, "component", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined"), "components")
