"""Dimensions, the fact, the bridges and the demand marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode import schemas
from postlode.functions.numbers import active_since, percentage
from postlode.functions.text import surrogate_key
from postlode.operators.skew import split_join
from postlode.operators.tagging import region_rows, tag
from postlode.params import Params

# Postings whose pairs one task joins and makes unique.
POSTINGS_PER_TASK = 50_000


def dimension(df: DataFrame, name: str, key: str) -> DataFrame:
    """Distinct non-null names with a key. The key ignores case, the row does not."""
    return (
        df.select(name).where(F.col(name).isNotNull()).distinct()
        .select(surrogate_key(name).alias(key), name)
    )


def dim_company(unified: DataFrame) -> DataFrame:
    return dimension(unified, "company_name", "company_id")


def dim_skill(skills: DataFrame) -> DataFrame:
    return skills.select(
        surrogate_key("skill_name").alias("skill_id"), "skill_name", "category", "match_keyword"
    )


def with_activity_flag(df: DataFrame, params: Params) -> DataFrame:
    """Add ``is_active``: seen within the window that ends at ``as_of``."""
    flag = active_since(F.col("last_seen_at"), params.as_of, params.active_window_days)
    return df.withColumn("is_active", flag)


def fact_postings(unified: DataFrame, params: Params) -> DataFrame:
    """One row per posting, with its company key and activity.

    The company dimension holds exactly the names of this table, and its key is
    a function of the name. Looking a name up in it is therefore the same as
    computing the key, without a join on names of which one may be very common.
    ``attach_dimension`` is the join, for a dimension built elsewhere.
    """
    keyed = unified.withColumn("company_id", surrogate_key("company_name"))
    return with_activity_flag(keyed, params).select(*schemas.FACT.names)


def attach_dimension(df: DataFrame, dim: DataFrame, name: str, split_by: str | None = None) -> DataFrame:
    """Left join to a dimension on its exact, case-sensitive name.

    With ``split_by``, a column that varies among a name's rows, names that hold much of ``df`` are
    split over copies of their dimension row.
    """
    return df.join(dim, name, "left") if split_by is None else split_join(df, dim, name, split_by)


def bridge_job_skill(postings: DataFrame, skills: DataFrame) -> DataFrame:
    """(posting, skill) pairs found in description or tags; the title is not searched."""
    carry = [c for c in ("is_active",) if c in postings.columns]
    return tag(postings, skills, text=["description", "tags"], label="skill_id", carry=carry)


def bridge_job_region(fact: DataFrame, regions: DataFrame, params: Params) -> DataFrame:
    """(posting, region) pairs; a posting has one row per region it hires from."""
    carry = [c for c in ("is_active",) if c in fact.columns]
    return region_rows(fact, regions, carry=carry, default=params.default_region)


def with_activity(bridge: DataFrame, fact: DataFrame) -> DataFrame:
    """Bridge pairs with their posting's activity, for a bridge stored without it.

    Both sides are cut by the number of postings. Ids compress so well that partitions merged by their
    bytes would hold many millions of pairs, all of which a task sorts in its memory.
    """
    activity = fact.select("job_id", "is_active")
    parts = -(-fact.count() // POSTINGS_PER_TASK)
    if parts <= 1:
        return bridge.join(activity, "job_id")
    return bridge.repartition(parts, "job_id").join(activity.repartition(parts, "job_id"), "job_id")


def _one_value(df: DataFrame, value: Column) -> Column:
    """A whole-table figure as a scalar subquery: computed once, joined to nothing."""
    return df.select(value).scalar()


def skill_demand(dim: DataFrame, pairs: DataFrame, fact: DataFrame) -> DataFrame:
    """Per skill: postings that mention it, active and all-time, with shares.

    ``pairs`` are unique, so counting rows counts postings. Skills no posting
    mentions appear with 0.
    """
    counts = pairs.groupBy("skill_id").agg(
        F.count_if("is_active").alias("active_n"), F.count(F.lit(1)).alias("all_n")
    )
    return demand_of_counts(dim, counts, fact)


def demand_of_counts(dim: DataFrame, counts: DataFrame, fact: DataFrame) -> DataFrame:
    """``skill_demand`` from ``skill_id, active_n, all_n``."""
    totals = fact.agg(
        F.count_if("is_active").alias("active_postings"), F.count(F.lit(1)).alias("all_postings")
    )
    active, everything = F.coalesce("active_n", F.lit(0)), F.coalesce("all_n", F.lit(0))
    return dim.join(counts, "skill_id", "left").select(
        "skill_id",
        "skill_name",
        "category",
        active.alias("postings_count"),
        percentage(active, _one_value(totals, F.col("active_postings")), 2).alias(
            "pct_of_active_postings"
        ),
        everything.alias("all_time_postings_count"),
        percentage(everything, _one_value(totals, F.col("all_postings")), 2).alias(
            "pct_of_all_postings"
        ),
    )


def skill_demand_distinct(dim: DataFrame, pairs: DataFrame, fact: DataFrame) -> DataFrame:
    """``skill_demand`` for pairs that may repeat: counts distinct postings.

    Pairs are made unique first, which spreads over all postings, so that no
    single skill's postings have to be counted in one task. Pairs that come from
    ``with_activity`` are already partitioned by posting and are not shuffled again.
    """
    return skill_demand(dim, pairs.dropDuplicates(["job_id", "skill_id"]), fact)


def region_demand(pairs: DataFrame, fact: DataFrame) -> DataFrame:
    """Per region with an active posting: active postings and their share of all active ones.

    A posting counts once in each of its regions.
    """
    total = fact.agg(F.count_if("is_active").alias("n"))
    return (
        pairs.where("is_active")
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("postings_count"))
        .select(
            "region",
            "postings_count",
            percentage(F.col("postings_count"), _one_value(total, F.col("n")), 1).alias(
                "pct_of_active_postings"
            ),
        )
    )
