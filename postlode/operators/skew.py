"""Joins to a dimension whose keys are uneven: a few names may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A hot key's rows are cut so that this many pieces make up an average partition.
PIECES = 16
# Counters of the sketch for each key that may be hot.
COUNTERS = 8


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """``hot_key, pieces`` of the keys that hold over half an average shuffle partition.

    There can be no more of them than twice the partitions, so the sketch and its result are bounded whatever the
    table holds. Its counts are estimates: a key taken for hot, or missed, costs time and changes no row.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = 2 * partitions
    counted = df.agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {COUNTERS * k}) FILTER (WHERE `{key}` IS NOT NULL)").alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    share = F.col("found.count") * partitions / F.col("n")
    return (
        counted.select(F.explode("top").alias("found"), "n")
        .where((share > 0.5) & F.col("found.item").isNotNull())
        .select(F.col("found.item").alias("hot_key"), F.ceil(share * PIECES).cast("int").alias("pieces"))
    )


def split_join(df: DataFrame, dim: DataFrame, key: str, by: str, how: str = "left") -> DataFrame:
    """``df.join(dim, key, how)`` with the rows of hot keys spread over copies of the dimension's rows.

    ``by`` is a column that varies among the rows of a key; a row's piece follows from its value alone, so
    a task that runs again deals its rows alike. Rows without a key match nothing and are spread too.
    ``how`` is left, inner, left_semi or left_anti: joins that keep no unmatched dimension row, which would come out
    once a copy.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would repeat the dimension's rows")
    hot = F.broadcast(hot_keys(df, key))  # at most two rows a shuffle partition
    pieces = F.when(F.col(key).isNull(), F.lit(1 << 20)).otherwise(F.coalesce("pieces", F.lit(1)))
    left = (
        df.join(hot, F.col(key) == F.col("hot_key"), "left")
        .withColumn("_piece", F.pmod(F.xxhash64(by), pieces).cast("int"))
        .drop("hot_key", "pieces")
    )
    last = F.coalesce("pieces", F.lit(1)) - 1
    right = (
        dim.join(hot, F.col(key) == F.col("hot_key"), "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
        .drop("hot_key", "pieces")
    )
    return left.join(right, [key, "_piece"], how).drop("_piece")
