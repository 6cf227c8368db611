"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.llm import bottomk, bpe, collocations, divergence, interpolation, lattice, mixing, segment_search, severity, surrogates, token_counts, url_filter, warc
from textmart.llm.common import small_batches

WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The key of the surrogates; a run on real data takes its own from where secrets are kept.
SURROGATE_KEY = "corpus"
LANGUAGE_WEIGHTS = [("en", 0.4), ("de", 0.2), ("fr", 0.2), ("es", 0.2)]
URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
]


def op1_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.score_texts(table(spark, folder, "documents"))


def op2_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY).select("doc_id", "n_entities", "new_text")


def op3_severity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = severity.fit_severity(docs, table(spark, folder, "labels"))
    scored = severity.score_severity(docs, model)
    return scored.select("doc_id", "severity", "p_toxic", "grade", (F.col("p_toxic") >= severity.REJECT).alias("rejected"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filter.judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def with_domain(docs: DataFrame) -> DataFrame:
    """The documents with a domain: one of four groups of sources."""
    return docs.withColumn("domain", F.concat(F.lit("domain"), F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 4))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    weights = {"lang": spark.createDataFrame(LANGUAGE_WEIGHTS, "lang string, weight double")}
    # Half of all tokens; sources by the root of their size.
    return mixing.mix(docs, None, weights=weights, share=0.5).drop("text")


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, public_tokenizers.path(WORD_BPE)).drop("text")


def op8_segment_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return segment_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op9_bottomk(spark: SparkSession, folder: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, folder, "documents"))


def op10_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.linked_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages").select("page_id", "url", "html"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents").select("text", "lang", "source"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.phrases(table(spark, folder, "documents").select("text", "lang"))


QUERIES = {
    f.__name__: f
    for f in (op1_interpolation, op2_surrogates, op3_severity, op4_token_counts, op5_url_filter, op6_mixing, op7_bpe, op8_segment_search, op9_bottomk, op10_lattice, op11_warc, op12_divergence, op13_collocations)
}
