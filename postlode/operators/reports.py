"""The reductions a dashboard shows, as small results computed by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode.functions.text import label_with_fallback
from postlode.operators.upsert import latest_per_key


def headline(fact: DataFrame, demand: DataFrame, status: DataFrame) -> DataFrame:
    """One row: postings tracked, active postings, companies hiring, skills tracked, last run.

    ``nunique`` semantics: NULL keys are not counted.
    """
    active_company = F.when(F.col("is_active"), F.col("company_id"))
    return fact.agg(
        F.count(F.lit(1)).alias("total_postings"),
        F.count_if("is_active").alias("active_postings"),
        F.countDistinct(active_company).alias("companies_hiring"),
    ).select(
        "*",
        demand.agg(F.countDistinct("skill_id")).scalar().alias("skills_tracked"),
        F.coalesce(status.select("overall").scalar(), F.lit("n/a")).alias("last_run"),
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of each source; sources silent for over a day before the newest run drop out."""
    latest = latest_per_key(runs, ["source"], F.col("started_at"), F.col("run_id"))
    newest = runs.agg(F.max("started_at")).scalar()
    return latest.where(F.col("started_at") >= newest - F.expr("interval 1 day"))


def latest_run_status(runs: DataFrame) -> DataFrame:
    """FAILED if any source's latest run did not succeed, with a breakdown newest first.

    No row at all if there were no runs.
    """
    latest = latest_runs(runs)
    newest_first = F.sort_array(
        F.collect_list(F.struct("started_at", "run_id", "source", "status")), asc=False
    )
    text = F.transform(newest_first, lambda r: F.concat(r["source"], F.lit(": "), r["status"]))
    any_failed = F.bool_or(F.col("status") != "success")
    return latest.agg(
        F.when(any_failed, "FAILED").otherwise("SUCCESS").alias("overall"),
        F.array_join(text, ", ").alias("breakdown"),
        F.count(F.lit(1)).alias("n_sources"),
    ).where("n_sources > 0").drop("n_sources")


def run_history(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id"))


def with_place(rows: DataFrame, *order: Column) -> DataFrame:
    """Number all rows in an order, with no task that sees more than its range of them.

    Rows are cut into ranges and sorted there; a range's first place follows from the sizes of the
    ranges before it, which is as many rows as there are ranges. The number of ranges is
    stated, so both uses of them are cut alike.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    numbered = ordered.select("*", F.shiftright(at, 33).alias("_range"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    return (
        numbered.join(F.broadcast(firsts), "_range")  # a row per range
        .withColumn("place", F.col("_first") + F.col("_at") + 1)
        .drop("_range", "_at", "_first")
    )


def with_category_label(demand: DataFrame) -> DataFrame:
    return demand.withColumn("category_label", label_with_fallback("category"))


def matched_skills(demand: DataFrame) -> DataFrame:
    return with_category_label(demand.where("all_time_postings_count > 0"))


def categories(demand: DataFrame) -> DataFrame:
    """Labels of the categories with a match, in order."""
    return matched_skills(demand).select("category_label").distinct().orderBy("category_label")


def top_skills(
    demand: DataFrame, k: int = fixed.TOP_SKILLS, category: str = fixed.ALL_CATEGORIES
) -> DataFrame:
    """The k skills with most postings of all time, of one category or of all; ties by name."""
    rows = matched_skills(demand)
    if category != fixed.ALL_CATEGORIES:
        rows = rows.where(F.col("category_label") == category)
    return rows.orderBy(F.desc("all_time_postings_count"), "skill_name").limit(k)


def region_ranking(regions: DataFrame, pinned: str = fixed.UNSPECIFIED) -> DataFrame:
    """The unspecified region first, the others by ascending count."""
    return regions.orderBy((F.col("region") == pinned).desc(), "postings_count", "region")


def active_listing(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Active postings with their company, ready to show.

    Postings without a company key match nothing. Each gets a key of its own
    that no company has, so that a join that shuffles spreads them over all
    tasks and does not gather them as one NULL group.
    """
    key = F.coalesce("company_id", F.concat(F.lit("none:"), F.col("job_id")))
    active = fact.where("is_active").select(
        key.alias("company_id"), "title", "location", "posting_url"
    )
    return (
        active.join(companies, "company_id", "left")
        .select("title", "company_name", "location", "posting_url")
        .fillna(
            {
                "company_name": fixed.UNSPECIFIED,
                "location": fixed.UNSPECIFIED,
                "posting_url": "",
            }
        )
    )


def trend(daily: DataFrame, demand: DataFrame, k: int = fixed.TREND_SKILLS) -> DataFrame:
    """Daily counts of the k most mentioned skills, once there are two days to compare."""
    top = (
        demand.orderBy(F.desc("all_time_postings_count"), "skill_name")
        .limit(k).select("skill_name").distinct()
    )
    days = daily.agg(F.countDistinct("snapshot_date")).scalar()
    return (
        daily.join(F.broadcast(top), "skill_name", "left_semi")  # at most k rows
        .where(days >= fixed.MIN_TREND_DAYS)
        .orderBy("snapshot_date", "skill_name")
    )
