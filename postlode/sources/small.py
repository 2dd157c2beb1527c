"""Spread scans of few splits over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a file scan that comes in fewer splits than there are cores.

    For scans whose rows are costly to process, such as long texts. Input large
    enough to fill the cluster is left as it is, so nothing is shuffled at scale.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan
