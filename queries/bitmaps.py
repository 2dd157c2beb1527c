"""Distinct counts merged from days' bitmaps."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlode.functions.text import surrogate_key
from postlode.operators import marts
from postlode.operators.bitmaps import bitmaps, distinct_counts
from postlode.sources.tables import Warehouse
from queries import models  # noqa: F401  (registers the SQL)
from queries.files import folder
from queries.registry import ORACLES, as_double, query

DAYS = T.StructType().add("day", "date").add("skill_id", "string").add("bucket", "long").add("bits", "binary")
# Line items shipped before this instant come on the first day, the others on the second.
SECOND = datetime(1998, 1, 1)


@query(ORACLES["distinct_filtered_counts"])
def merged_day_counts(t):
    """Distinct orders per brand, open and all, from two days' stored bitmaps; the second day is written twice."""
    parts = t.part.select("p_partkey", surrogate_key("p_brand").alias("skill_id"))
    lines = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    table = Warehouse(t.spark, folder(t.spark, "warehouse")).table("bitmaps", DAYS)
    second = F.col("l_shipdate") >= F.lit(SECOND)
    for day, rows in (("2026-01-01", ~second), ("2026-01-02", second), ("2026-01-02", second)):
        found = bitmaps(lines.where(rows), "l_orderkey", "skill_id").withColumn("day", F.lit(day).cast("date"))
        table.replace_parts(found, F.col("day"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").alias("is_active"))
    brands = marts.dimension(t.part, "p_brand", "skill_id").select(
        "skill_id", F.col("p_brand").alias("skill_name"), F.lit("brand").alias("category")
    )
    counts = distinct_counts(table.read(), bitmaps(orders.where("is_active"), "id"), "skill_id")
    demand = marts.demand_of_counts(brands, counts, orders)
    return demand.withColumns(as_double("pct_of_active_postings", "pct_of_all_postings"))
