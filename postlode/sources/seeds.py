"""Keyword and translation seeds, from CSV files or from the built-in rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A UTF-8 CSV with a header row; quoted fields may hold commas and doubled quotes."""
    return spark.read.csv(
        path, schema=schema, header=True, quote='"', escape='"', encoding="UTF-8",
        enforceSchema=False, mode="FAILFAST",
    )


def seed_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows known to the driver. As an Arrow table they become a literal part of the plan,
    so that reading or measuring them runs no job."""
    columns = dict(zip(schema.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table(columns), schema)
