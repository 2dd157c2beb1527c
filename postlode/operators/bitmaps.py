"""Distinct counts that merge: exact bitmaps of ids, kept per day and key.

A day's pairs are read once and become bitmaps of 32,768 ids each. Counts over any days come
from the bitmaps alone: those of one key and range are joined by OR, so an id that several days hold counts once,
and a day that is written again changes nothing else. Ids are integers, best without wide
gaps: a bitmap takes 4 KB however few of its ids occur. A null id counts nothing; a null key is a key.

A key that holds most of the rows is many ranges, each its own group, and map tasks combine theirs before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(pairs: DataFrame, id_column: str, *keys: str) -> DataFrame:
    """``keys, bucket, bits``: the distinct ids of each key; rows may repeat."""
    ids = pairs.where(F.col(id_column).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(id_column).cast("long"))
    position = F.bitmap_bit_position(F.col(id_column).cast("long"))
    return ids.groupBy(*keys, bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """The same over all rows of ``parts``, which may hold a key and bucket once per day."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def within(found: DataFrame, allowed: DataFrame, *keys: str) -> DataFrame:
    """``found`` cut to the ids of ``allowed``, which has one row per ``bucket``."""
    other = allowed.select("bucket", F.col("bits").alias("_allowed"))
    both = found.join(other, "bucket").select(*keys, "bucket", F.explode(F.array("bits", "_allowed")).alias("bits"))
    return both.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))


def distinct_counts(parts: DataFrame, active: DataFrame, *keys: str) -> DataFrame:
    """``keys, active_n, all_n`` over all days of ``parts``; ``active`` has the bitmaps of the ids that are active now."""
    everything = merged(parts, *keys)
    # Null keys meet as well, so the two counts are joined by a union.
    kinds = everything.withColumn("_active", F.lit(False)).unionByName(
        within(everything, active, *keys).withColumn("_active", F.lit(True))
    )
    size = F.bitmap_count("bits")
    return kinds.groupBy(*keys).agg(
        F.sum(F.when(F.col("_active"), size).otherwise(0)).alias("active_n"),
        F.sum(F.when(~F.col("_active"), size).otherwise(0)).alias("all_n"),
    )
