"""What the physical plans must and must not hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

import queries
from postlode.operators import marts
from postlode.operators.upsert import latest_per_key, upsert
from postlode.sources.small import spread_scan
from samples import T0

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
def test_no_query_pairs_rows_without_a_key(spark):
    for name, query in queries.QUERIES.items():
        text = plan(query(spark, SF_DIR))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
@pytest.mark.parametrize(
    "name, columns",
    [
        ("check_unique", "struct<o_custkey:bigint>"),
        ("category_allow_list", "struct<event_id:bigint,event_type:string>"),
        ("check_relationships", "struct<l_suppkey:bigint>"),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(queries.QUERIES[name](spark, SF_DIR))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["landed_postings_a", "unified_postings", "posting_region_demand", "html_unescape"])
def test_no_query_runs_python(spark, name):
    assert "Python" not in plan(queries.QUERIES[name](spark, SF_DIR))


def big(spark, name):
    """A side too large to broadcast, by its statistics."""
    return spark.range(10**9).select(F.col("id").cast("string").alias(name), (F.col("id") > 5).alias("is_active"))


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    text = plan(latest_per_key(df, ["k"], F.col("v")))
    exchange = text.index("Exchange")
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]


def test_upsert_shuffles_each_side_once(spark):
    columns = ["job_id", "payload", "source", "first_seen_at", "last_seen_at"]
    target = spark.range(10**9).selectExpr(
        "cast(id as string) job_id", "'x' payload", "'s' source",
        "timestamp_seconds(id) first_seen_at", "timestamp_seconds(id) last_seen_at",
    )
    batch = target.select("job_id", "payload", "source")
    merged = upsert(target, batch, T0)
    assert merged.columns == columns
    assert plan(merged).count("Exchange hashpartitioning") == 2


def test_distinct_counts_reuse_the_join_partitioning(spark):
    pairs = big(spark, "job_id").select("job_id", F.lit("s").alias("skill_id"))
    fact = big(spark, "job_id")
    unique = marts.with_activity(pairs, fact).dropDuplicates(["job_id", "skill_id"])
    assert plan(unique).count("Exchange hashpartitioning") == 2


def test_pairs_of_more_postings_are_joined_in_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(marts, "POSTINGS_PER_TASK", 10, raising=False)
    for n in (40, 400):
        fact = spark.range(n).selectExpr("id as job_id", "id % 2 = 0 as is_active")
        pairs = spark.range(3 * n).selectExpr(f"id % {2 * n} as job_id", "'s' as skill_id")
        unique = marts.with_activity(pairs, fact).dropDuplicates(["job_id", "skill_id"])
        assert unique.rdd.getNumPartitions() == n // 10
        assert unique.count() == n and unique.where("is_active").count() == n // 2


def test_wide_scans_are_not_shuffled(spark, folder):
    spark.range(1000).repartition(32).write.parquet(f"{folder}/wide")
    spark.range(1000).coalesce(1).write.parquet(f"{folder}/narrow")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    try:
        assert "Exchange" not in plan(spread_scan(spark.read.parquet(f"{folder}/wide"), "id"))
        assert "Exchange" in plan(spread_scan(spark.read.parquet(f"{folder}/narrow"), "id"))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
