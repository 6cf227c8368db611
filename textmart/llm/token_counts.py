"""Token counts without ids: pieces are counted once per distinct pre-token.

1. All texts are split; pre-tokens are counted in each task, then over all.
2. Each distinct pre-token's pieces are counted once, by the merge rounds of
   `textmart.llm.bpe`, and stored.
3. The texts' pre-token frequencies meet the stored counts and are summed.

Step 3 joins on the pre-token. The most frequent ones (at most HEAD_WORDS, each at
most HEAD_CHARS long, so a few MB) would make nearly all of that join's rows and
all of its skew; they are sent to the tasks and met there, as are longer ones that
make up more than 1/COMMON of all. All others are joined by a shuffle. Both ways give the same sums.

Defined cases: a null or empty text has 0 tokens and 0 bytes. A special string
inside a text is one token. Rows are counted by row, so repeated rows (and ids)
stay apart. An empty table gives no rows. Columns with other names are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.bpe import Bpe, PreTokens
from textmart.llm.common import RowNumbers, arrow_texts, by_value, slices, written

HEAD_WORDS = 200_000
HEAD_CHARS = 32
# Longer words go with them if more than one in so many occurrences is theirs.
COMMON, LONG_CHARS = 2000, 4096
# Distinct pre-tokens a task holds before it hands them on.
FLUSH_WORDS = 500_000


def pre_token_totals(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(piece_of, total): how often each pre-token occurs; special strings are left out."""
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = PreTokens(source.value), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["piece_of", "total"])
            seen.clear()
            return out

        for batch in slices(batches, text):
            for value in arrow_texts(batch.column(text)).to_pylist():
                seen.update(split(value))
            for special in split.special.values():
                seen.pop(special, None)
            if len(seen) > FLUSH_WORDS:
                yield flush()
        yield flush()

    counted = docs.select(text).mapInArrow(by_value(run), "piece_of string, total long")
    return counted.groupBy("piece_of").agg(F.sum("total").alias("total"))


def piece_counts(totals: DataFrame, tokenizer: str) -> DataFrame:
    """(piece_of, total, pieces): the pieces of each distinct pre-token."""
    source = totals.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(source.value)
        for batch in slices(batches, "piece_of", 1 << 20):
            pieces = bpe.counts(batch.column("piece_of").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], names=["piece_of", "total", "pieces"])

    return totals.mapInArrow(by_value(run), "piece_of string, total long, pieces long")


def frequent_words(counted: DataFrame, head_words: int) -> DataFrame:
    """(piece_of, pieces) of at most `head_words` of the most frequent short words, and of longer
    ones with more than 1/COMMON of all occurrences, fewer than COMMON.

    A histogram of the totals in steps of 1/8 octave gives the least total, so no task sorts all words.
    """
    short = F.length("piece_of") <= HEAD_CHARS
    step = F.floor(8 * F.log2("total")).cast("int")
    steps = counted.groupBy(step.alias("step")).agg(F.count_if(short).alias("words"), F.sum("total").alias("total")).collect()
    least, words = None, 0
    for row in sorted(steps, reverse=True):
        words += row.words
        if words > head_words:
            break
        least = row.step
    often = F.col("total") > sum(r.total for r in steps) / COMMON
    picked = often & (F.length("piece_of") <= LONG_CHARS)
    if least is not None:
        picked = picked | (short & (step >= least))
    return counted.where(picked).select("piece_of", "pieces")


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 2048, head_words: int = HEAD_WORDS) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of `docs`."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    counted = written(piece_counts(pre_token_totals(docs, tokenizer, "_text"), tokenizer), "pieces")
    head = spark.sparkContext.broadcast({r.piece_of: r.pieces for r in frequent_words(counted, head_words).collect()})
    source = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    kind = docs.schema["_key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, numbers, known = PreTokens(source.value), RowNumbers(), head.value
        for batch in slices(batches, "_text"):
            rows = numbers.take(batch.num_rows).tolist()
            texts = arrow_texts(batch.column("_text"))
            sums, rare_rows, rare, times = [], [], [], []
            for row, value in zip(rows, texts.to_pylist()):
                total, rest = 0, []
                for word in split(value):
                    pieces = known.get(word)
                    if pieces is not None:
                        total += pieces
                    elif isinstance(word, int):
                        total += 1
                    else:
                        rest.append(word)
                sums.append(total)
                found = Counter(rest)
                rare_rows += [row] * len(found)
                rare += found
                times += found.values()
            # A row of its own for each text. Its key is no pre-token (those with digits hold
            # nothing else) and differs from row to row, so that these rows spread.
            n, m = batch.num_rows, len(rare)
            keys = pa.concat_arrays([batch.column("_key"), pa.nulls(m, batch.column("_key").type)])
            yield pa.RecordBatch.from_arrays([
                pa.array(rows + rare_rows, pa.int64()), keys,
                pa.concat_arrays([pc.binary_length(texts).cast(pa.int64()), pa.nulls(m, pa.int64())]),
                pa.array([f"\0{r}" for r in rows] + rare, pa.string()),
                pa.array(sums + times, pa.int64()),
            ], names=["_row", "_key", "n_bytes", "piece_of", "times"])

    met = docs.mapInArrow(by_value(run), f"_row long, _key {kind.simpleString()}, n_bytes long, piece_of string, times long")
    met = met.join(counted.select("piece_of", "pieces"), "piece_of", "left")
    tokens = F.sum(F.col("times") * F.coalesce("pieces", F.lit(1)))
    out = met.groupBy("_row").agg(F.max("_key").alias(key), F.max("n_bytes").alias("n_bytes"), tokens.alias("n_tokens"))
    return out.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
