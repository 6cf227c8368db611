"""Sources. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textmart import schemas as S
from textmart.functions.text import strip
from textmart.operators.incremental import nonblank
from textmart.operators.model import latest
from textmart.session import scratch_path
from textmart.sources.ranges import RANGE_BYTES, csv_records, json_elements


def read_csv(spark: SparkSession, schema, path: str, *more: Column, multi_line: bool = False) -> DataFrame:
    """The schema's columns by their names in the header, in any order; absent ones are NULL.

    Files of one folder share their header. Nothing is inferred but the names.
    """
    # Quotes inside a field are doubled.
    raw = (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"').option("inferSchema", False).csv(path)
    )
    named = [F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None) for f in schema]
    return raw.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(named, schema)], *more)


def read_job_ids_csv(spark: SparkSession, path: str) -> DataFrame:
    """(job_id, url) rows with an id; a missing path gives no row."""
    rows = load_or_empty(spark, lambda: read_csv(spark, S.JOB_IDS, path), S.JOB_IDS)
    return nonblank(rows, "job_id")


def read_html_cache_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(job_id, html_text): ids trimmed, blank ids dropped, last row of an id wins.

    Rows are ordered by their `seq`, as `write_html_csv` numbers them. Files without it
    (a cache that others appended to, one file) are ordered by position in the file.
    The cache's writer collapses newlines, so one line is one record and large files
    are split; set `multi_line` for files that others wrote, with newlines inside quotes.
    Those are split too, by ranges that know whether they begin within quotes.
    """
    place = F.struct(*[F.col(f"_metadata.{p}") for p in ("file_name", "file_block_start")])
    if multi_line:
        records, header = csv_records(spark, path)
        named = [(F.get("fields", header.index(f.name)) if f.name in header else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.JOB_HTML_CSV]
        raw = records.select(*named, F.struct("file", "place").alias("_place"))
    else:
        raw = load_or_empty(
            spark, lambda: read_csv(spark, S.JOB_HTML_CSV, path, place.alias("_place")), S.JOB_HTML_CSV
        )
    ordered = raw.withColumn("_pos", F.monotonically_increasing_id())
    seq = F.struct(*[c for c in ("seq", "_place", "_pos") if c in ordered.columns])
    rows = nonblank(ordered.withColumn("job_id", strip(F.col("job_id"))), "job_id")
    return latest(rows, "job_id", seq).select(
        "job_id", F.coalesce("html_text", F.lit("")).alias("html_text")
    )


def read_html_cache_table(spark: SparkSession, table: str) -> DataFrame:
    """The cache kept in a catalog table, one row per id."""
    return spark.table(table).select(F.col("job_id").cast("string"), "html_text")


def read_html_cache_jdbc(
    spark: SparkSession, url: str, table: str, partitions: int = 1,
    hash_of_id: str = "hashtext(job_id)", **options: str,
) -> DataFrame:
    """The cache kept in a database, read in `partitions` parts by a hash of the id.

    Text ids have no bounds to split by, so each part is a condition on `hash_of_id`,
    a whole number in the database's own SQL. Needs the database's JDBC driver on the
    class path; `options` are passed on. Not tested: no database is at hand.
    """
    conditions = hash_conditions(hash_of_id, partitions)
    rows = spark.read.jdbc(url, table, predicates=conditions, properties=options)
    return rows.select(F.col("job_id").cast("string"), "html_text")


def hash_conditions(hash_of_id: str, partitions: int) -> list[str]:
    """SQL conditions that hold for one part each, and together for every row."""
    if partitions <= 1:
        return ["1 = 1"]
    part = f"ABS(MOD({hash_of_id}, {partitions}))"
    return [f"{part} = 0 OR {hash_of_id} IS NULL", *[f"{part} = {i}" for i in range(1, partitions)]]


def read_entries_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested entries from JSON arrays or lines; missing or malformed gives no row."""

    def load():
        # An array written over many lines needs multiLine; so does a broken one.
        return (
            spark.read.schema(S.ENTRY).option("multiLine", True).option("mode", "DROPMALFORMED")
            .json(path)
        )

    return load_or_empty(spark, load, S.ENTRY)


def read_entries_json_array(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`read_entries_json` of files that are JSON arrays of objects, one large file in many tasks.

    A file that is cut off, is no array of objects or holds an object that is malformed gives
    no row, as with the reader in one task. Objects are cut out by byte ranges and parsed natively.
    """
    found = json_elements(spark, path, range_bytes)
    parsed = F.from_json("element", StructType([*S.ENTRY.fields, StructField("_broken", StringType())]), {"columnNameOfCorruptRecord": "_broken"})
    entries = found.select("file", "element", parsed.alias("entry"))
    # Stored once: whether a file is whole is known only when all its parts were read.
    folder = scratch_path(spark, "elements")
    entries.write.parquet(folder)
    entries = spark.read.schema(entries.schema).parquet(folder)
    broken = entries.where(F.col("element").isNull() | F.col("entry._broken").isNotNull()).select("file").distinct()
    whole = entries.join(broken, "file", "left_anti")
    return whole.select(*[F.col(f"entry.{f.name}").alias(f.name) for f in S.ENTRY])


def read_entries_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """The splittable form: one entry per line, as `write_entries_json` writes it."""
    return load_or_empty(
        spark,
        lambda: spark.read.schema(S.ENTRY).option("mode", "DROPMALFORMED").json(path),
        S.ENTRY,
    )


def read_processed_ids(jobs: DataFrame, key: str = "job_id") -> DataFrame:
    return jobs.select(key).distinct()


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Skill dictionary (canonical, alias, pos) from a CSV with header."""
    return read_csv(spark, S.DICTIONARY, path)


def load_or_empty(spark: SparkSession, load, schema) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
