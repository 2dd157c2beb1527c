"""Session settings this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Results depend on these, so they are set on whatever session is used.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Sizing for a cluster run. AQE merges small shuffle partitions and splits hot
# ones, so the partition count is an upper bound and not a tuning knob per query.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # INT96, the default, carries no statistics, so no filter could skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Recording the call site of every column call makes planning several times slower.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def use_result_settings(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "postlode", **settings: str) -> SparkSession:
    """A session with the cluster sizing; ``settings`` override it."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_SETTINGS, **RESULT_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
