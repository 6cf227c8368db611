"""Phrases whose words occur together more often than their parts would by chance.

Per language, phrases of 2 to 5 words of one piece of a text (pieces end at punctuation
and line ends) that occur at least `least` times are candidates. A candidate's score is the
lowest, over its cuts in two parts, of 1000 * a * n / (l * r), rounded down.

1. Each chunk's n-grams, sorted, become a count transducer (`automata`), which is cut at
   the bounds of prefix ranges of all phrases. A range's transducers meet in one task, which
   unites them, summing weights, and keeps phrases of at least `least` occurrences.
2. This is done for one and two words, then three, then four and five: a phrase reaches
   `least` only if its parts do, so a chunk counts a longer phrase only if its parts of the
   length before are in a bit map of the frequent ones. The map has a fixed size
   (`filter_bits`): what it lets through in vain costs work, never changes a count.
3. The frequent transducers of a range are united, and the candidates' parts, sent to their
   ranges, are composed with them: that gives l and r. A part looked up by very many
   candidates is spread over tasks by the candidate.
4. A candidate inside a longer one that is as frequent goes: it suffices that a candidate
   one word longer tells its two parts of one word less.

Bounds: ranges hold about RANGE_BYTES of text, and a chunk hands over at most FAN transducers
of neighbouring ranges; beyond FAN ranges these are united and cut again in a second
shuffle, in tasks that hold HELD arcs. The bounds come from a sample of at most
`SAMPLE` windows of texts, and only balance the work. The driver sees them and the bit map.

Defined cases: a null text is empty, a null language `und`. Repeated rows and ids count as
rows. A text without words adds nothing. Equal scores rank by a, then by phrase in byte
order. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.llm import automata
from textmart.llm.automata import Automaton
from textmart.llm.common import arrow_texts, by_value, gathered, hashes, mixed, written

LONGEST = 5
CHUNK = 8 << 20
RANGE_BYTES = 16 << 20
FAN, MOST_RANGES = 256, 65_536
SAMPLE = 400_000
# Arcs a task holds before it unites them.
HELD = 3_000_000
# Looked-up parts of one task.
LOOKUPS = 50_000
DEAL = 32
# Kinds of bytes: 1 between words, 2 between pieces. Bytes of longer characters belong to words.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts in order; each word's text; how many words its piece has from it on."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = KIND[raw]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    bytes_before = np.cumsum(inside, dtype=np.int64)
    places = np.append(bytes_before[starts] - 1, inside.sum()).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(LOWER[raw[inside]].tobytes()))
    text = np.searchsorted(offsets, starts, "right") - 1
    ends = np.cumsum(kind == 2, dtype=np.int32)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (ends[1:] != ends[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    left = np.append(first[1:], len(starts))[np.cumsum(new) - 1] - np.arange(len(starts)) if len(starts) else np.zeros(0, np.int64)
    return words, text, left


def path_hashes(langs: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """A hash of the phrase of `length` words at each place; of a shorter one at the last places."""
    out = mixed(langs, words)
    for j in range(1, length):
        out[: len(out) - j] = mixed(out[: len(out) - j], words[j:])
    return out


def in_map(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    at = hashed & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shard_counts(table: pa.Table, low: int, high: int, frequent: np.ndarray | None) -> Automaton:
    """The transducer of a chunk's phrases of `low` to `high` words whose parts of `low - 1` words are in the map."""
    words, text, left = split_words(arrow_texts(table.column("text")))
    vocabulary, label = automata.sorted_words(words)
    langs, lang = automata.sorted_words(table.column("lang").combine_chunks().cast(pa.large_string()))
    lang = lang[text]
    size = max(len(vocabulary), 1)
    at, part = np.flatnonzero(left >= low), low - 1
    if frequent is not None:
        ok = (left >= part) & in_map(frequent, path_hashes(hashes(langs)[lang], hashes(vocabulary)[label], part))
        at = at[ok[at] & ok[at + 1]]
    out = Automaton(langs.to_pylist(), vocabulary, [], [], [])
    state = lang[at]
    for d in range(1, high + 1):
        if d > low:
            on = left[at] >= d
            if frequent is not None:
                on[on] = ok[at[on] + d - part]
            at, state = at[on], state[on]
        parents, labels, state = automata.step(state, label[at + d - 1], size)
        out.parents.append(parents)
        out.labels.append(labels)
        out.weights.append(np.bincount(state, minlength=len(labels)) if d >= low else np.zeros(len(labels), np.int64))
    return out


def shipped(pieces: Iterator[tuple[int, Automaton]], salt: int) -> pa.RecordBatch:
    rows = [(r, salt, automata.dumps(a)) for r, a in pieces]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.binary()))], names=["range", "salt", "counts"])


def united(batches: Iterator[pa.RecordBatch], bounded: bool) -> Iterator[tuple[int, int, Automaton]]:
    """Unions of the rows of each range (rows come sorted by range); if `bounded`, several of at most about HELD arcs."""
    now, held, arcs, salt = None, [], 0, 0
    for batch in batches:
        for r, s, data in zip(batch.column("range").to_pylist(), batch.column("salt").to_pylist(), batch.column("counts")):
            if held and (r != now or arcs > HELD):
                held = [automata.union(held)]
                if r != now or bounded:
                    yield now, salt, held[0]
                    held = []
                arcs = 0
            now, salt = r, s
            held.append(automata.loads(data.as_buffer().to_pybytes()))
            arcs += held[-1].arcs
    if held:
        yield now, salt, automata.union(held)


def count_phrases(docs: DataFrame, bounds: list[tuple[str, ...]], low: int, high: int, least: int, frequent: np.ndarray | None, filter_bits: int) -> DataFrame:
    """(range, counts, bits, totals): of each range the transducer of frequent phrases, the places of the
    `high`-word ones (of the only length) in a bit map, and the number of words by language."""
    spark = docs.sparkSession
    width = math.ceil((len(bounds) + 1) / FAN)
    held = spark.sparkContext.broadcast((bounds, frequent))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, frequent = held.value
        for i, table in enumerate(gathered(batches, "text", CHUNK)):
            yield shipped(automata.cut(shard_counts(table, low, high, frequent), bounds[width - 1 :: width]), i)

    def recut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, salt, counts in united(batches, bounded=True):
            yield shipped(automata.cut(counts, held.value[0]), salt)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, counts in united(batches, bounded=False):
            sums = np.bincount(counts.parents[0], counts.weights[0], len(counts.langs)).astype(np.int64)
            kept = automata.pruned(counts, least)
            bits = []
            if len(kept.labels) == high and len(kept.labels[-1]):
                path, words = hashes(pa.array(kept.langs, pa.large_string())), hashes(kept.words)
                for parents, labels in zip(kept.parents, kept.labels):
                    path = mixed(path[parents], words[labels])
                bits = (path & np.uint64((1 << filter_bits) - 1)).astype(np.int64)
            yield pa.record_batch(
                [pa.array([r], pa.int32()), pa.array([automata.dumps(kept)], pa.binary()), pa.array([bits], pa.list_(pa.int64())), pa.array([list(zip(counts.langs, sums.tolist()))], pa.map_(pa.string(), pa.int64()))],
                names=["range", "counts", "bits", "totals"],
            )
            pa.default_memory_pool().release_unused()

    rows = docs.mapInArrow(by_value(count), "range int, salt int, counts binary")
    if width > 1:
        rows = rows.repartition("range", "salt").sortWithinPartitions("range").mapInArrow(by_value(recut), rows.schema)
    ranged = rows.repartitionById(len(bounds) + 1, "range").sortWithinPartitions("range")
    return written(ranged.mapInArrow(by_value(unite), "range int, counts binary, bits array<long>, totals map<string, long>"), f"phrases{high}")


def bit_map(counts: DataFrame, filter_bits: int) -> np.ndarray:
    """The frequent phrases' places in one map of 2**filter_bits bits, put together from pieces of 32,768."""
    places = counts.select(F.explode("bits").alias("place"))
    pieces = places.groupBy(F.shiftright("place", 15).cast("int").alias("piece")).agg(F.bitmap_construct_agg((F.col("place") % 32768)).alias("bits"))
    out = np.zeros((1 << filter_bits) // 8, np.uint8)
    for piece, bits in pieces.collect():  # at most 2**(filter_bits - 15) rows of 4 KB
        out[piece * 4096 : piece * 4096 + 4096] = np.frombuffer(bits, np.uint8)
    return out


def range_bounds(docs: DataFrame, n_ranges: int, rows: int) -> list[tuple[str, ...]]:
    """At most `n_ranges` - 1 phrases (language, words...) that cut all phrases to ranges of about equal work."""
    wanted = min(SAMPLE, 40 * n_ranges)
    per_text = 16

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            words, text, left = split_words(arrow_texts(table.column("text")))
            langs = table.column("lang").to_pylist()
            ends = np.searchsorted(text, np.arange(table.num_rows + 1))
            picks = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.linspace(a, b - 1, min(per_text, b - a)).astype(np.int64) for a, b in zip(ends, ends[1:]) if b > a]]))
            # Long words are cut: a bound need not be a phrase that occurs.
            found = [[langs[text[i]], *[words[int(i) + j].as_py()[:32] for j in range(min(LONGEST, int(left[i])))]] for i in picks]
            yield pa.record_batch([pa.array(found, pa.list_(pa.string()))], names=["path"])

    fraction = min(1.0, wanted / per_text / max(rows, 1))
    sample = docs.sample(fraction=fraction, seed=1) if fraction < 1 else docs
    paths = sorted({tuple(r.path) for r in sample.mapInArrow(by_value(windows), "path array<string>").limit(2 * wanted).collect()})
    return sorted({paths[i * len(paths) // n_ranges] for i in range(1, n_ranges)}) if paths else []


def part_rows(bounds: list[tuple[str, ...]]):
    """From transducers to their candidates' parts (with the range that knows them), and to what they tell shorter ones."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("counts"):
                out = []
                for lang, words, a in automata.phrases_of(automata.loads(data.as_buffer().to_pybytes()), 2):
                    for k in range(1, len(words)):
                        for side, part in (("l", words[:k]), ("r", words[k:])):
                            out.append((bisect.bisect_right(bounds, (lang, *part)), lang, " ".join(words), a, k, side, " ".join(part), None))
                    for shorter in (words[:-1], words[1:]) if len(words) > 2 else ():
                        out.append((None, lang, " ".join(shorter), None, None, None, None, a))
                columns = list(zip(*out)) if out else [()] * len(PARTS)
                yield from pa.table([pa.array(c, f.type) for c, f in zip(columns, PARTS)], schema=PARTS).to_batches(max_chunksize=20_000)

    return rows


PARTS = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("k", pa.int32()), ("side", pa.string()), ("part", pa.string()), ("longer", pa.int64())])
ANSWER = "lang string, phrase string, a long, k int, side string, f long"


def answer(parts: pa.Table, counts: pa.Table) -> pa.Table:
    """Each looked-up part with its count, from the composition with the range's transducers."""
    whole = automata.union([automata.loads(c.as_buffer().to_pybytes()) for c in counts.column("counts")]) if counts.num_rows else Automaton([], pa.array([], pa.large_string()), [], [], [])
    f = automata.weights_of(whole, [(lang, *part.split(" ")) for lang, part in zip(parts.column("lang").to_pylist(), parts.column("part").to_pylist())])
    return parts.select(["lang", "phrase", "a", "k", "side"]).append_column("f", pa.array(f, pa.int64()))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, filter_bits: int = 26, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first `top` phrases."""
    read = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    size = read.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    n_ranges = min(MOST_RANGES, max(1, math.ceil((size.bytes or 0) / range_bytes)))
    bounds = range_bounds(read, n_ranges, size.rows)

    counted, frequent = [], None
    for low, high in ((1, 2), (3, 3), (4, LONGEST)):
        counted.append(count_phrases(read, bounds, low, high, least, frequent, filter_bits))
        frequent = bit_map(counted[-1], filter_bits) if high < LONGEST else None
    totals = counted[0].select(F.explode("totals").alias("lang", "words")).groupBy("lang").agg(F.sum("words").alias("n"))
    counts = counted[0].select("range", "counts")
    for more in counted[1:]:
        counts = counts.unionAll(more.select("range", "counts"))

    found = written(counts.mapInArrow(by_value(part_rows(bounds)), "range int, lang string, phrase string, a long, k int, side string, part string, longer long"), "parts")
    asked = found.where("longer is null")
    # A range asked by many candidates answers in several tasks.
    salts = asked.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / LOOKUPS).cast("int").alias("salts"))
    salts = written(salts, "salts")
    asked = asked.join(F.broadcast(salts), "range").withColumn("salt", F.pmod(F.xxhash64("lang", "phrase"), F.col("salts")).cast("int"))  # a row a range
    holders = counts.join(F.broadcast(salts), "range").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    answered = asked.select("range", "salt", "lang", "phrase", "a", "k", "side", "part").groupBy("range", "salt").cogroup(holders.select("range", "salt", "counts").groupBy("range", "salt")).applyInArrow(by_value(answer), ANSWER)

    cuts = answered.groupBy("lang", "phrase", "k").agg(F.max("a").alias("a"), F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    # Decimals of 38 digits: exact while 1000 * a * n is below 10**38.
    score = F.call_function("div", (whole["a"] * whole["n"]).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)"), (whole["l"] * whole["r"]).cast("decimal(38,0)"))
    scored = cuts.join(totals, "lang").select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"), F.lit(None).cast("long").alias("longer"))
    told = found.where("longer is not null").select("lang", "phrase", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("n"), F.lit(None).cast(scored.schema["cut"].dataType).alias("cut"), "longer")
    best = scored.unionAll(told).groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), F.min("cut").alias("cut"), F.max("longer").alias("longer"))
    best = best.where("a is not null and (longer is null or longer < a)").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # Of a language's DEAL parts each gives its first ones, so the last task has DEAL * top rows at most.
    best = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(DEAL)))
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
