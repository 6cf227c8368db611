import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from textmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "textmart-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": "/tmp/textmart-tests-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Run an expression builder over literal values, in order."""
    from pyspark.sql import functions as F

    def run(values, expression, schema="v STRING"):
        df = spark.createDataFrame(
            [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)],
            "i INT, " + schema,
        )
        cols = [F.col(c) for c in df.columns[1:]]
        out = df.repartition(3).select("i", expression(*cols).alias("o")).collect()
        return [r.o for r in sorted(out, key=lambda r: r.i)]

    return run
