import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("wardbook-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small DataFrame from rows and a schema text; instants are given as text."""

    def make(rows, schema):
        fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
        plain = ", ".join(f"`{n}` {'string' if t == 'timestamp_ntz' or t.startswith('dec') else t}" for n, t in fields)
        types = {"dec": "decimal(18,2)"}
        return spark.createDataFrame(rows, plain).selectExpr(
            *[f"cast(`{n}` as {types.get(t, t)}) `{n}`" for n, t in fields]
        )

    return make
