"""Connected components of a link table by alternating large-star and small-star steps.

Each step joins the links to the smallest neighbour of each node, so a component shrinks to a star around
its smallest node in a logarithmic number of rounds. Every round is a written table; nothing
but a row count and a checksum of the links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.shared import discard, stored


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``a, b`` links; the component is its smallest node."""
    a, b = F.col("a"), F.col("b")
    stars = stored(
        links.where((a != b) & a.isNotNull() & b.isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    before = _signature(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = stored(small, "small-star")
        now = _signature(after)
        discard(large)
        discard(stars)
        stars = after
        if now == before:
            break
        before = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
