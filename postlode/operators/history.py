"""Daily snapshots: one row per day and key, safe to rerun."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.operators.upsert import replace_by_key
from postlode.sources.tables import Table


def snapshot(demand: DataFrame, day: date) -> DataFrame:
    return demand.select(
        F.lit(day).alias("snapshot_date"),
        "skill_id", "skill_name", "category", "postings_count", "pct_of_active_postings",
    )


def append_snapshot(table: Table, rows: DataFrame, day: date) -> None:
    """Write one day's rows; a rerun replaces them by key and leaves other days alone.

    Replacement is by (day, skill): a skill dropped between two runs of the same
    day keeps its earlier row. Only that day's part is read or written.
    """
    merged = replace_by_key(table.read([str(day)]), rows, ["snapshot_date", "skill_id"])
    table.replace_parts(merged, F.col("snapshot_date"))
