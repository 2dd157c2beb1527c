"""Keyed upsert with first-seen and last-seen times, and replacement by key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode.sources.tables import Table


def latest_per_key(
    df: DataFrame, keys: Sequence[str], *order: Column
) -> DataFrame:
    """One whole row per key: the last in ``order``.

    Spark cuts each map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key that holds most of the rows stays small.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where("_rank = 1")
        .drop("_rank")
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    now: datetime,
    *,
    key: str = "job_id",
    keep: Sequence[str] = ("source",),
    replace: Sequence[str] = ("payload",),
) -> DataFrame:
    """Merge a batch with one row per key into the target.

    New keys get ``first_seen_at = last_seen_at = now``. Known keys take the
    batch's ``replace`` columns and ``now`` as last seen, and keep first seen and
    the ``keep`` columns. Keys absent from the batch are left as they are.
    """
    t, b = target.alias("t"), batch.alias("b")
    joined = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    in_batch = F.col(f"b.{key}").isNotNull()
    at = F.lit(now).cast("timestamp")
    columns = {
        key: F.coalesce(f"t.{key}", f"b.{key}"),
        **{c: F.when(in_batch, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")) for c in replace},
        **{
            c: F.when(F.col(f"t.{key}").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))
            for c in keep
        },
        "first_seen_at": F.coalesce("t.first_seen_at", at),
        "last_seen_at": F.when(in_batch, at).otherwise(F.col("t.last_seen_at")),
    }
    return joined.select(*[columns[c].alias(c) for c in target.columns])


def upsert_table(table: Table, batch: DataFrame, now: datetime) -> None:
    """Upsert a keyed batch into a published table cut by first-seen day.

    A key's first-seen day never changes, so it stays in its partition. The batch's keys
    are looked up in the narrow key and time columns, and only the days that hold one of
    them, and the day of ``now``, where new keys go, are rewritten. The rest of the table,
    which grows without end, is neither shuffled nor copied.
    """
    day = F.to_date("first_seen_at")
    known = table.read().select("job_id", day.alias("day")).join(batch.select("job_id"), "job_id", "left_semi")
    today = table.spark.range(1).select(F.to_date(F.lit(now).cast("timestamp")).alias("day"))
    touched = known.select("day").union(today).distinct().collect()  # at most one row per day of history
    table.replace_parts(upsert(table.read([str(r.day) for r in touched]), batch, now), day)


def replace_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows whose key is not in ``new``, and all of ``new``."""
    return existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new)
