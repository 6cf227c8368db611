"""Documents made ready for training: one stage after the other, each stored as Parquet.

A stage takes what its predecessor kept, with the columns of `documents`; the last one
gives each row's token count and digests instead of its text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.llm import bottomk, bpe, mixing, severity, surrogates
from textmart.llm.common import small_batches, written
from textmart.llm.queries import LANGUAGE_WEIGHTS, SURROGATE_KEY, WORD_BPE, table, with_domain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the severity model takes for toxic go."""
    model = severity.fit_severity(docs, table(spark, sf_dir, "labels"))
    return severity.score_severity(docs, model).where(F.col("p_toxic") < severity.REJECT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    A repeated id stays with each of its different texts; of rows with equal id and text one
    stays, the first in order of their other columns. Rows without an id stay.
    """
    small_batches(spark)
    copies = written(bottomk.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct(), "copies")
    repeated = written(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    left = docs.join(copies, "doc_id", "left_anti")
    once = left.join(repeated, "doc_id", "left_anti")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    several = left.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("first"))
    return once.select(*COLUMNS).unionByName(several.select("doc_id", "text", "first.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data and secrets."""
    changed = surrogates.replace_entities(docs, SURROGATE_KEY)
    changed = changed.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("new_text").cast("long")).otherwise(F.col("n_chars")))
    return changed.withColumn("text", F.col("new_text")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text with a word once (null, empty and blank ones go), and another fifth of all tokens by weight; a row for each time a text is taken."""
    weights = {"lang": spark.createDataFrame(LANGUAGE_WEIGHTS, "lang string, weight double")}
    mixed = mixing.mix(with_domain(docs), None, weights=weights, share=1.2, least_epochs=1)
    return mixed.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs")))).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each row."""
    small_batches(spark)
    return bpe.encode_decode(docs, public_tokenizers.path(WORD_BPE)).drop("text")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("encoding", encoding)]

# The stages learn, hash and encode: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
