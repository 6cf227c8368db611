"""Language-model scores by deleted interpolation.

P(w | h) = a2 * c(h w) / c(h) + a1 * c(w) / N + a0 / (V + 1), the weights depending on
the bucket floor(log2 c(h)) of the context's frequency (a bucket of its own for
contexts never seen, which have no a2). Counts come from the training texts. For the
weights, one part of the training texts is set aside: the model of the others'
counts is mixed so that the part's events are likeliest, by expectation-maximisation.
The scores then use the counts of all training texts.

How it runs:

1. Texts are cut into chunks of a few MB and stored: each chunk's distinct words (as
   64-bit hashes), its texts as places in them, and nothing else. Texts set aside and
   others are in chunks of their own.
2. Each chunk gives its distinct words and word pairs once, with their counts, as
   packed sorted arrays, one for each of as many shares of the hash range as the input
   needs. A share adds up its chunks and answers each with the totals, in its order. A
   frequent word is one entry per chunk, so no key makes a task large.
3. The chunks set aside meet their totals and give a histogram of events (bucket, and
   the ratios of the estimates in steps of 1/8 octave), of bounded size, from which the
   weights are learned on the driver.
4. All chunks meet their totals and are scored.

Words are told apart by 64-bit hashes, so counts could only differ from those of the
words themselves if two hashes collided (about n^2 / 2^65 for n distinct keys).

Defined cases: a null or empty text is one token, the end. Texts whose id is null are
training texts. Repeated rows are scored, and counted, each. Without training tokens
the base is undefined in the limit; c, N and V are 0 and every token has P = 1. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import RowNumbers, arrow_texts, ascii_words, by_value, gathered, hashes, input_bytes, mixed, written

# Kinds of texts.
TRAINING, SET_ASIDE, HELD_OUT = 0, 1, 2
CHUNK_BYTES = 2 << 20  # of text, so that a chunk and its totals are a few dozen MB when unpacked
NO_ID = 4  # added to the kind of a text whose id is null
# Bytes of stored chunks whose keys one share adds up.
SHARE_BYTES = 3 << 20
STEPS = 8  # per octave, of the event histogram
END, START = np.uint64(0x45E4D), np.uint64(0x57A27)
BUCKETS = 64
TEXT_COLUMNS = "chunk string, kind int, keys binary, rows binary, sizes binary, kinds binary, vocabulary binary, places binary"


def folds(key: Column) -> Column:
    """crc32 of the id as text, modulo 7: 2 is held out, 3 is set aside for the weights."""
    fold = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7
    return F.when(key.isNull(), TRAINING).when(fold == 2, HELD_OUT).when(fold == 3, SET_ASIDE).otherwise(TRAINING).cast("int")


def squeeze(a: np.ndarray) -> bytes:
    """The length, then the bytes of like weight side by side, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def expand(raw: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    flat = np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True) if size else b"", np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(width, size // width).T).view(kind).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=np.uint64(0)))


def expand_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(expand(raw, np.uint64), dtype=np.uint64)


def chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored chunks of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = RowNumbers()
        for table in gathered(batches, "_text", CHUNK_BYTES):
            kinds = table.column("_kind").to_numpy()
            rows = numbers.take(table.num_rows)
            for aside in (True, False):
                mine = np.flatnonzero((kinds == SET_ASIDE) == aside)
                if not len(mine):
                    continue
                part = table.take(pa.array(mine))
                index, vocabulary, first = ascii_words(arrow_texts(part.column("_text")))
                words = hashes(vocabulary)
                order = np.argsort(words)
                place = np.empty(len(order), np.uint32)
                place[order] = np.arange(len(order), dtype=np.uint32)
                ids = part.column("_key").cast(pa.int64())
                keys, marks = ids.fill_null(0).to_numpy(), kinds[mine] + NO_ID * ids.is_null().to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array([str(rows[mine[0]])]), pa.array([SET_ASIDE if aside else TRAINING], pa.int32()),
                    *[pa.array([squeeze(x)], pa.binary()) for x in (keys.astype(np.int64), rows[mine], np.diff(first).astype(np.uint32), marks.astype(np.uint8))],
                    pa.array([squeeze_sorted(words[order])], pa.binary()), pa.array([squeeze(place[index])], pa.binary()),
                ], names=[c.split()[0] for c in TEXT_COLUMNS.split(", ")])

    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), folds(F.col(key)).alias("_kind"))
    return written(picked.mapInArrow(by_value(run), TEXT_COLUMNS), "chunks")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row after the other; a row is a chunk, so not all are unpacked at once."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]
        pa.default_memory_pool().release_unused()


class Chunk:
    """The tokens of a chunk's texts, one after the other, and its distinct keys."""

    def __init__(self, row: dict) -> None:
        self.keys, self.rows = expand(row["keys"], np.int64), expand(row["rows"], np.int64)
        self.sizes, self.kinds = expand(row["sizes"], np.uint32).astype(np.int64), expand(row["kinds"], np.uint8)
        self.no_id, self.kinds = self.kinds >= NO_ID, self.kinds % NO_ID
        words = expand_sorted(row["vocabulary"])
        n = len(words)
        places = expand(row["places"], np.uint32).astype(np.int64)
        # Tokens: each text's words and its end. Contexts: its start and its words.
        self.first = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        total = int((self.sizes + 1).sum())
        last = self.first + self.sizes
        tokens, contexts = np.full(total, n), np.full(total, n + 1)
        inner = np.ones(total, bool)
        inner[last] = False
        tokens[inner] = places
        inner = np.ones(total, bool)
        inner[self.first] = False
        contexts[inner] = places
        names = np.append(words, [END, START])
        pair, pair_of = np.unique(tokens * (n + 2) + contexts, return_inverse=True)
        pairs = mixed(names[pair % (n + 2)], names[pair // (n + 2)])
        # One sorted list of keys: words, end, start, pairs.
        every = np.concatenate([names, pairs])
        order = np.argsort(every, kind="stable")
        self.every = every[order]
        at = np.empty(len(every), np.int64)
        at[order] = np.arange(len(every))
        self.token_at, self.context_at, self.pair_at = at[tokens], at[contexts], at[n + 2 :][pair_of]
        trained = np.repeat(self.kinds != HELD_OUT, self.sizes + 1)
        counted = [self.token_at[trained], self.pair_at[trained], at[[n + 1]].repeat((self.kinds != HELD_OUT).sum())]
        self.counts = np.bincount(np.concatenate(counted), minlength=len(every))

    def spans(self, shares: int) -> np.ndarray:
        """Where each share of the hash range begins in the sorted keys (one more than shares)."""
        cuts = np.array([(i << 64) // shares for i in range(1, shares)], np.uint64)
        return np.concatenate([[0], np.searchsorted(self.every, cuts), [len(self.every)]])


def totals(stored: DataFrame, shares: int) -> DataFrame:
    """(chunk, parts): for each chunk and share, the counts of its keys over all training texts,
    and for chunks set aside also over the texts set aside."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                mine = Chunk(row)
                at = mine.spans(shares).tolist()
                full = [(i, a, b) for i, (a, b) in enumerate(zip(at, at[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _, _ in full], pa.int32()), pa.array([row["chunk"]] * len(full)), pa.array([row["kind"]] * len(full), pa.int32()),
                    pa.array([squeeze_sorted(mine.every[a:b]) for _, a, b in full], pa.binary()),
                    pa.array([squeeze(mine.counts[a:b].astype(np.uint32)) for _, a, b in full], pa.binary()),
                ], names=["share", "chunk", "kind", "keys", "counts"])

    def add(key, table):
        parts = [expand_sorted(x) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([expand(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        aside = np.repeat(table.column("kind").to_numpy() == SET_ASIDE, [len(p) for p in parts])
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        every = np.bincount(at, counts).astype(np.int64)
        apart = np.bincount(at, counts * aside, minlength=len(every)).astype(np.int64)
        ends = np.cumsum([len(p) for p in parts])
        answers = [at[e - len(p) : e] for p, e in zip(parts, ends)]
        kinds = table.column("kind").to_pylist()
        return pa.table({
            "chunk": table.column("chunk"), "share": table.column("share"),
            "every": pa.array([squeeze(every[a].astype(np.uint64)) for a in answers], pa.binary()),
            "apart": pa.array([squeeze(apart[a].astype(np.uint64)) if k == SET_ASIDE else None for a, k in zip(answers, kinds)], pa.binary()),
        })

    given = stored.mapInArrow(by_value(give), "share int, chunk string, kind int, keys binary, counts binary")
    summed = given.groupBy("share").applyInArrow(by_value(add), "chunk string, share int, every binary, apart binary")
    return summed.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("share", "every", "apart"))).alias("parts"))


def corpus_size(stored: DataFrame, shares: int) -> tuple[int, int, int]:
    """Training tokens N, distinct training tokens V, and the tokens set aside."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                kinds, sizes = expand(row["kinds"], np.uint8) % NO_ID, expand(row["sizes"], np.uint32).astype(np.int64)
                words, places = expand_sorted(row["vocabulary"]), expand(row["places"], np.uint32)
                trained = np.repeat(kinds != HELD_OUT, sizes)
                seen = words[np.unique(places[trained])]
                tokens, aside = int((sizes[kinds != HELD_OUT] + 1).sum()), int(row["kind"] == SET_ASIDE)
                cuts = np.searchsorted(seen, np.array([(i << 64) // shares for i in range(1, shares)], np.uint64))
                parts = np.split(seen, cuts)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(shares, dtype=np.int32)), *[pa.array([t] + [0] * (shares - 1), pa.int64()) for t in (tokens, tokens * aside)], pa.array([squeeze_sorted(p) if len(p) else None for p in parts], pa.binary())], names=["share", "tokens", "aside", "words"])

    def count(key, table):
        words = [expand_sorted(x) for x in table.column("words").to_pylist() if x is not None]
        distinct = len(np.unique(np.concatenate(words))) if words else 0
        sums = {c: pa.array([sum(table.column(c).to_pylist())], pa.int64()) for c in ("tokens", "aside")}
        return pa.table(sums | {"words": pa.array([distinct], pa.int64())})

    given = stored.select("kind", "kinds", "sizes", "vocabulary", "places").mapInArrow(by_value(give), "share int, tokens long, aside long, words binary")
    row = given.groupBy("share").applyInArrow(by_value(count), "tokens long, aside long, words long").agg(F.sum("tokens"), F.sum("words"), F.sum("aside")).first()
    n, distinct, aside = (int(x or 0) for x in row)
    return n, distinct + (n > 0), aside  # the end is a token, too


def estimates(mine: Chunk, counts: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """For each token: its context's bucket, c(h w) / c(h), c(w) / N, and 1 / (V + 1)."""
    context = counts[mine.context_at]
    bucket = np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)
    return bucket, counts[mine.pair_at] / np.maximum(context, 1), counts[mine.token_at] / max(n, 1), 1.0 / (v + 1)


def met(stored: DataFrame, answers: DataFrame) -> DataFrame:
    return stored.join(answers, "chunk")


def counts_of(row: dict, name: str) -> np.ndarray:
    return np.concatenate([expand(p[name], np.uint64) for p in row["parts"]]).astype(np.int64)


def event_histogram(stored: DataFrame, answers: DataFrame, n: int, v: int) -> list:
    """(bucket, steps of pair / word estimate, steps of word estimate / uniform, events) of the texts set aside."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                mine = Chunk(row)
                bucket, two, one, zero = estimates(mine, counts_of(row, "every") - counts_of(row, "apart"), n, v)
                steps = [np.where(x > 0, np.round(STEPS * np.log2(np.where(x > 0, x, 1) / zero)), -9999).astype(np.int64) for x in (two, one)]
                cells, times = np.unique(np.column_stack([bucket, *steps]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(cells[:, i]) for i in range(3)], pa.array(times)], names=["bucket", "two", "one", "times"])

    aside = met(stored.where(F.col("kind") == SET_ASIDE), answers)
    found = aside.mapInArrow(by_value(give), "bucket long, two long, one long, times long")
    return found.groupBy("bucket", "two", "one").agg(F.sum("times").alias("times")).collect()


def learn_weights(events: list, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) mixture weights of pair, word and uniform estimate, by expectation-maximisation."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if events:
        cells = np.array([[e.bucket, e.two, e.one, e.times] for e in events], np.float64)
        bucket = cells[:, 0].astype(np.int64)
        p = np.column_stack([np.where(cells[:, i] > -9999, 2.0 ** (cells[:, i] / STEPS), 0.0) for i in (1, 2)] + [np.ones(len(cells))])
        # A few events as the weights before learning, so that rare buckets stay near them.
        prior = weights * 5.0
        for _ in range(rounds):
            share = weights[bucket] * p
            share *= (cells[:, 3] / share.sum(axis=1))[:, None]
            sums = prior + np.column_stack([np.bincount(bucket, share[:, i], minlength=BUCKETS) for i in range(3)])
            weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


SCORES = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", share_bytes: int = SHARE_BYTES) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    stored = chunks(docs, key, text)
    shares = max(32, input_bytes(stored) // share_bytes)
    n, v, aside = corpus_size(stored, 16 * (1 + shares // 64))
    answers = written(totals(stored, shares), "counts")
    weights = learn_weights(event_histogram(stored, answers, n - aside, v))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                mine, counts = Chunk(row), counts_of(row, "every")
                bucket, two, one, zero = estimates(mine, counts, n, v)
                mix = weights[bucket]
                p = mix[:, 0] * two + mix[:, 1] * one + mix[:, 2] * zero if n else np.ones(len(bucket))
                c = counts[mine.token_at]
                base = np.log10((c + 1) / (n + 1 * (v + 1)))
                sums = [np.add.reduceat(x, mine.first) for x in ((c > 0).astype(np.int64), base, np.log10(p))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(mine.keys, mask=mine.no_id), pa.array(mine.kinds == HELD_OUT), pa.array(mine.sizes + 1), pa.array(sums[0]),
                    pa.array(np.full(len(mine.keys), n)), pa.array(sums[1]), pa.array(sums[2]),
                ], names=[key, *[c.split()[0] for c in SCORES.split(", ")]])

    return met(stored, answers).mapInArrow(by_value(give), f"{key} long, {SCORES}")
