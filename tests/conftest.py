import os
import tempfile

import pytest
from pyspark.sql import SparkSession

os.environ.setdefault("PYSPARK_PYTHON", "python")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("postlode-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of named values."""

    def evaluate(expression, schema="s string", *values):
        row = spark.createDataFrame([tuple(values)], schema)
        return row.select(expression.alias("r")).first().r

    return evaluate
