"""Land one source: read, filter, key, repair, upsert, log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.operators import landing
from postlode.operators.runlog import log_run
from postlode.operators.staging import stage_source_a, stage_source_b
from postlode.operators.upsert import latest_per_key, upsert_table
from postlode.sources.dumps import read_array_dump, read_envelope_dump
from postlode.sources.tables import Table, Warehouse, remove_folder

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceSpec:
    """What is particular to a source. A new source is one more of these.

    ``keep``, ``key`` and ``clean`` are column rules over the JSON text
    ``payload`` and its parsed ``fields``, the struct ``p``.
    """

    name: str
    read: Callable[[SparkSession, str], DataFrame]  # -> payload, position
    fields: T.StructType
    keep: Callable[[], Column]
    key: Callable[[], Column]
    stage: Callable[[DataFrame], DataFrame]
    clean: Callable[[], Column] = lambda: F.col("payload")


SOURCE_A = SourceSpec(
    name=fixed.SOURCE_A,
    read=read_array_dump,
    fields=schemas.SOURCE_A_LANDING,
    keep=landing.keep_source_a,
    key=landing.key_source_a,
    clean=landing.clean_source_a,
    stage=stage_source_a,
)
SOURCE_B = SourceSpec(
    name=fixed.SOURCE_B,
    read=read_envelope_dump,
    fields=schemas.SOURCE_B_LANDING,
    keep=landing.keep_source_b,
    key=landing.key_source_b,
    stage=stage_source_b,
)
SOURCES = (SOURCE_A, SOURCE_B)


def raw_table(warehouse: Warehouse, source: str) -> Table:
    return warehouse.table(f"raw/{source}_jobs", schemas.RAW_POSTINGS)


def keyed_batch(spec: SourceSpec, postings: DataFrame) -> DataFrame:
    """Kept postings under their keys. Filter and key see the text as it came; then it is repaired."""
    return landing.with_payload(postings, spec.fields).where(spec.keep()).select(
        spec.key().alias("job_id"),
        spec.clean().alias("payload"),
        F.lit(spec.name).alias("source"),
        "position",
    )


def land_batch(
    warehouse: Warehouse,
    spec: SourceSpec,
    postings: DataFrame,
    now: datetime,
    when_read: Callable[[], None] = lambda: None,
) -> int:
    """Upsert one batch of raw postings; returns the rows kept, repeats of a key included.

    ``when_read`` is called once the postings have been read, before the table changes.
    """
    spark = warehouse.spark
    table = raw_table(warehouse, spec.name)
    table.ensure()
    # The batch is counted, looked up and merged: written once, so that the
    # dump is parsed and repaired once and a lost executor costs no more.
    staged = f"{warehouse.root}/_staged/{uuid.uuid4().hex}"
    try:
        kept = keyed_batch(spec, postings)
        kept.write.parquet(staged)
        when_read()
        batch = spark.read.schema(kept.schema).parquet(staged)
        rows = batch.count()
        if rows:
            last = latest_per_key(batch, ["job_id"], F.col("position")).drop("position")
            upsert_table(table, last, now)
    finally:
        remove_folder(spark, staged)
    return rows


def run_source(
    warehouse: Warehouse,
    spec: SourceSpec,
    path: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> int:
    """Land a source's dump and log the run, whether it succeeds or fails.

    The log counts all records read, before the filter. A failure is logged
    with its message and raised again; a log that cannot be written never hides
    the first error. The data is published before the run is logged, so a
    logged success always has its data.
    """
    started = clock()
    fetched = 0
    try:
        read = Observation()
        postings = spec.read(warehouse.spark, path).observe(read, F.count(F.lit(1)).alias("rows"))

        def when_read() -> None:
            nonlocal fetched
            fetched = read.get["rows"]

        kept = land_batch(warehouse, spec, postings, clock(), when_read)
        log_run(
            warehouse, source=spec.name, fetched=fetched, upserted=kept, started_at=started,
            finished_at=clock(), status="success",
        )
        logger.info("%s: read %d postings, landed %d", spec.name, fetched, kept)
        return kept
    except Exception as error:
        logger.exception("%s: landing failed", spec.name)
        try:
            log_run(
                warehouse, source=spec.name, fetched=fetched, upserted=0, started_at=started,
                finished_at=clock(), status="failed", error=str(error),
            )
        except Exception:
            logger.exception("%s: the failure could not be logged either", spec.name)
        raise
