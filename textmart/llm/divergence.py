"""How far the sources of a language lie apart, and by which terms: an audit over term counts.

Tasks count terms with Arrow alone (`ascii_lower`, `split_pattern_regex`,
`dictionary_encode`, hash `group_by`) and merge their chunks' counts before the shuffle.
Merged counts are dealt by (language, term); a language keeps the terms that enough of its
rows hold. Kept counts then form columnar shards, blocks of terms of one language, in
which the smoothed shares of all its sources stand side by side: each shard gives its part
of every pair's distance and its own best terms, and Spark sums and ranks them.

The share of a term with `count` occurrences in a source or language of N is
1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)), V the language's kept terms, in whole
numbers (exact below 9 * 10**15 occurrences). Part `pair` is the sum of the absolute
differences of two sources' shares over all kept terms, part `term` the surplus of a
source's share over its language's, best `top` only.

Bounds: a shard has about `shard_rows` counts. Sources of a language beyond `tile` are dealt
into tiles, and a shard compares two tiles; terms of neither tile are added at the end
from the two shares of a count of 0. A large source or language is spread over all shards.

Defined cases: null text, language and source are read as ''. A row counts as a document,
repeated ids and rows too. A source without terms takes part; with no kept term all pairs
have the value 0. A language with one source has no pairs. An empty table gives no rows.
Other columns are not read. Ties rank by item in byte order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.llm.common import arrow_texts, by_value, slices, written

GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, PRIOR = 1_000_000_000, 5
# Counts a task holds before it merges them, and hands them on if merging does not help.
HELD = 400_000
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
PARTS = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("seen", pa.int64()), ("gap", pa.int64()), ("v", pa.int64())])


def chunk_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) of a chunk."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(arrow_texts(batch.column("text"))), GAPS)
    words, rows = pieces.flatten(), pc.list_parent_indices(pieces)
    full = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(full).dictionary_encode()
    by_row = pa.table({"row": rows.filter(full), "code": coded.indices}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    groups = pa.table({"lang": pc.fill_null(batch.column("lang"), ""), "source": pc.fill_null(batch.column("source"), "")}).take(by_row.column("row"))
    keyed = groups.append_column("code", by_row.column("code")).append_column("n", by_row.column("count_all"))
    counts = keyed.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    terms = coded.dictionary.cast(pa.string()).take(counts.column("code").combine_chunks())
    return pa.table([counts.column("lang"), counts.column("source"), terms, counts.column("n_sum"), counts.column("n_count")], schema=COUNTS)


def merged(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return total.rename_columns(["lang", "source", "term", "n", "docs"]).cast(COUNTS)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for chunk in slices(batches, "text"):
        held.append(chunk_counts(chunk))
        if sum(t.num_rows for t in held) > HELD:
            held = [merged(held)]
            if held[0].num_rows > HELD // 2:
                yield from held[0].to_batches(max_chunksize=50_000)
                held = []
            pa.default_memory_pool().release_unused()
    if held:
        yield from merged(held).to_batches(max_chunksize=50_000)


def shares(counts: np.ndarray, total: np.ndarray | int, v: int) -> np.ndarray:
    """1 + floor(10**9 * (count + PRIOR) / (total + PRIOR * v)), by long division in thousands."""
    below = np.maximum(np.asarray(total, np.int64) + PRIOR * v, 1)
    rest, out = counts.astype(np.int64) + PRIOR, np.int64(0)
    for _ in range(3):  # SCALE is 1000 ** 3
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return out + 1


def compare(counts: pa.Table, groups: pa.Table, top: int, cells: int = 2_000_000) -> pa.Table:
    """A shard's part of the pairs' distances, and its best terms of each source.

    `counts`: (term, source, n, lang_n) of the sources of two tiles (or one);
    `groups`: (lang, source, tile, total, v, lang_total) of all of them.
    """
    if not groups.num_rows:
        return PARTS.empty_table()
    lang, v = groups.column("lang")[0].as_py(), groups.column("v")[0].as_py()
    lang_total = groups.column("lang_total")[0].as_py()
    names = groups.column("source").combine_chunks()
    totals, tiles = groups.column("total").to_numpy(), groups.column("tile").to_numpy()
    low, high = groups.column("low")[0].as_py(), groups.column("high")[0].as_py()
    coded = counts.column("term").combine_chunks().dictionary_encode()
    vocabulary = coded.dictionary
    order = np.empty(len(vocabulary), np.int64)
    order[pc.sort_indices(vocabulary).to_numpy()] = np.arange(len(vocabulary))
    term = order[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
    source = pc.index_in(counts.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
    n, lang_n = counts.column("n").to_numpy(), counts.column("lang_n").to_numpy()

    size = len(names)
    distance = np.zeros((size, size), np.int64)
    step = max(1, cells // max(size, 1))
    place = np.argsort(term, kind="stable")
    edges = np.searchsorted(term[place], np.arange(0, len(vocabulary) + step, step))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        at = place[a:b]
        grid = np.zeros((size, min(step, len(vocabulary) - i * step)), np.int64)
        grid[source[at], term[at] - i * step] = n[at]
        grid = shares(grid, totals[:, None], v)
        for s in range(size):
            distance[s, s + 1 :] += np.abs(grid[s + 1 :] - grid[s]).sum(axis=1)
    zero = shares(np.zeros(size, np.int64), totals, v)
    one, other = np.triu_indices(size, 1)
    if low != high:
        across = tiles[one] != tiles[other]
        one, other = one[across], other[across]
    pairs = pa.table(
        [pa.array(["pair"] * len(one), pa.string()), pa.array([lang] * len(one), pa.string()), names.take(pa.array(one)), names.take(pa.array(other)), pa.array(distance[one, other]), pa.array(np.full(len(one), len(vocabulary), np.int64)), pa.array(np.abs(zero[one] - zero[other])), pa.array(np.full(len(one), v, np.int64))],
        schema=PARTS,
    )
    if low != high:
        return pairs
    surplus = shares(n, totals[source], v) - shares(lang_n, lang_total, v)
    best = np.flatnonzero((surplus > 0) & (n > 0))
    best = best[np.lexsort((term[best], -surplus[best], source[best]))]
    starts = np.searchsorted(source[best], source[best])
    best = best[np.arange(len(best)) - starts < top]
    sorted_terms = vocabulary.take(pc.sort_indices(vocabulary))
    none = pa.array(np.zeros(len(best), np.int64))
    terms = pa.table([pa.array(["term"] * len(best), pa.string()), pa.array([lang] * len(best), pa.string()), names.take(pa.array(source[best])), sorted_terms.take(pa.array(term[best])), pa.array(surplus[best]), none, none, none], schema=PARTS)
    return pa.concat_tables([pairs, terms])


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, top: int = 50, shard_rows: int = 200_000, tile: int = 512) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's distance to every other of its language
    (`pair`), and the `top` terms that it has more of than its language (`term`)."""
    read = docs.select(F.col(text).cast("string").alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))])
    partial = read.mapInArrow(by_value(count_terms), "lang string, source string, term string, n long, docs long")
    # Dealt by (lang, term): the sums over sources below need no further shuffle.
    counts = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.select("*", F.sum("docs").over(of_term).alias("lang_docs"), F.sum("n").over(of_term).alias("lang_n"), F.min("source").over(of_term).alias("least"))
    kept = counts.where(F.col("lang_docs") >= min_docs).select("lang", "term", "source", "n", "lang_n", (F.col("source") == F.col("least")).cast("long").alias("first"))
    kept = written(kept, "term_counts")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    occurring = read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total", "firsts"])
    occurring = written(occurring, "sources")
    langs = occurring.groupBy("lang").agg(F.sum("firsts").alias("v"), F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("sources"))
    most = langs.agg(F.max("sources")).first()[0] or 0
    n_tiles, n_shards = max(1, math.ceil(most / tile)), max(1, math.ceil(kept.count() / shard_rows))

    def tiled(df: DataFrame) -> DataFrame:
        """Each row once for every tile its own is compared with."""
        own = F.pmod(F.xxhash64("source"), F.lit(n_tiles)).cast("int")
        met = df.withColumn("tile", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
        return met.withColumn("low", F.least("tile", "met")).withColumn("high", F.greatest("tile", "met")).drop("met")

    keys = ["lang", "low", "high", "shard"]
    cells = tiled(kept.drop("first")).withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("int"))
    groups = tiled(occurring.drop("firsts").join(langs.drop("sources"), "lang")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    compared = cells.groupBy(*keys).cogroup(groups.groupBy(*keys)).applyInArrow(
        by_value(lambda counts, groups: compare(counts, groups, top)), "part string, lang string, source string, item string, value long, seen long, gap long, v long"
    )
    compared = written(compared, "divergences")

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    # A tile pair has a term only if one of its sources has it: the others lie apart by their shares of a count of 0.
    pairs = compared.where("part = 'pair'").groupBy("lang", "source", "item").agg((F.sum("value") + (F.max("v") - F.sum("seen")) * F.max("gap")).alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", both.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    terms = compared.where("part = 'term'").select("lang", "source", "part", "item", "value")
    pairs, terms = (df.withColumn("rank", F.row_number().over(ranked)) for df in (pairs, terms))
    return pairs.unionByName(terms.where(F.col("rank") <= top))
