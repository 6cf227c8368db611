"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Nothing here is needed for right results: every operator also works on a
# session it did not build. These are the settings a long job should start from.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Pages are wide rows: bound an Arrow batch by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def build_session(app: str = "textmart", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, named by the cluster in spark.checkpoint.dir.

    A local[*] session without that setting (tests) gets a fresh temporary
    folder; a cluster session without it is refused, since a machine-local
    folder would not be seen by the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="textmart-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other run uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
