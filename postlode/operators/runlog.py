"""The append-only log of landing runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode import schemas
from postlode.functions.numbers import duration_seconds
from postlode.sources.tables import Warehouse

LOG = "raw/load_runs"


def log_run(
    warehouse: Warehouse,
    *,
    source: str,
    fetched: int,
    upserted: int,
    started_at: datetime,
    finished_at: datetime,
    status: str,
    error: str | None = None,
) -> None:
    row = (uuid.uuid4().hex, source, fetched, upserted, started_at, finished_at, status, error)
    warehouse.append(LOG, warehouse.spark.createDataFrame([row], schemas.LOAD_RUNS).coalesce(1))


def load_runs(warehouse: Warehouse) -> DataFrame:
    return warehouse.read_log(LOG, schemas.LOAD_RUNS)


def pipeline_runs(runs: DataFrame) -> DataFrame:
    """Runs with their duration in seconds."""
    return runs.withColumn(
        "duration_seconds", duration_seconds(F.col("started_at"), F.col("finished_at"))
    ).select(*schemas.PIPELINE_RUNS.names)
