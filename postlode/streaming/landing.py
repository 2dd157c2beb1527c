"""Land dumps as they arrive: the batch landing step, driven by a file stream.

The daily run lands one dump per source. This does the same for a folder that
new dump files are dropped into, and takes only files it has not seen.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlode.plans.ingest import SourceSpec, land_batch
from postlode.sources.tables import Warehouse


def land_arriving(
    warehouse: Warehouse,
    spec: SourceSpec,
    folder: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Land every JSON-lines file that is new in ``folder``, then stop.

    A micro-batch that is run again after a failure upserts the same keys, so
    it changes nothing but their last-seen time.
    """
    lines = (
        warehouse.spark.readStream.text(folder)
        .where(F.length(F.trim("value")) > 0)
        .select(
            F.col("value").alias("payload"),
            F.struct(
                F.col("_metadata.file_modification_time").alias("arrived"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
            ).alias("file"),
        )
    )

    def land(batch: DataFrame, _: int) -> None:
        placed = batch.select(
            "payload",
            F.struct("file", F.monotonically_increasing_id().alias("at")).alias("position"),
        )
        land_batch(warehouse, spec, placed, clock())

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{warehouse.root}/_streams/{spec.name}")
        .trigger(availableNow=True)
        .start()
    )
