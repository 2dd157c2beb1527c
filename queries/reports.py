"""Run history and the dashboard's reductions."""

from pyspark.sql import functions as F

from postlode import schemas
from postlode.operators import marts, reports
from postlode.operators.runlog import pipeline_runs
from queries.models import (
    REGION_DEMAND_SQL,
    SKILL_DEMAND_SQL,
    customer_region_demand,
    document_demand,
)
from queries.registry import as_double, micros, query

# Events as runs of five sources: errors failed, the value is the run's length in
# seconds, and one source went quiet a week before the others.
RUNS_SQL = """
    SELECT printf('%012d', event_id) AS run_id, event_type AS source, user_id::INT AS records_fetched,
           0 AS records_upserted,
           CASE WHEN event_type = 'signup' THEN ts - INTERVAL 7 DAY ELSE ts END AS started_at,
           value, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
    FROM events"""


def runs(t):
    started = F.when(
        F.col("event_type") == "signup", F.col("ts") - F.expr("interval 7 days")
    ).otherwise(F.col("ts"))
    length = (F.col("value") * 1000).cast("bigint")
    failed = F.col("event_type") == "error"
    return t.events.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("run_id"),
        F.col("event_type").alias("source"),
        F.col("user_id").cast("int").alias("records_fetched"),
        F.lit(0).alias("records_upserted"),
        started.alias("started_at"),
        F.timestamp_micros(F.unix_micros(started) + length * 1000).alias("finished_at"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, "event").alias("error_message"),
    ).select(*schemas.LOAD_RUNS.names)


@query(f"""
    SELECT run_id, source, records_fetched, epoch_us(started_at) AS started_us,
           trunc(value * 1000) * 1000 / 1e6 AS duration_seconds, status,
           CASE WHEN status = 'failed' THEN 'event' END AS error_message
    FROM ({RUNS_SQL})""")
def run_duration(t):
    """Runs with their length in seconds."""
    return pipeline_runs(runs(t)).select(
        "run_id", "source", "records_fetched", micros("started_at").alias("started_us"),
        "duration_seconds", "status", "error_message",
    )


@query(f"""
    SELECT run_id, source, status FROM ({RUNS_SQL})
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1
    AND started_at >= (SELECT max(started_at) FROM ({RUNS_SQL})) - INTERVAL 1 DAY""")
def latest_runs(t):
    """Newest run per source; a source quiet for over a day is left out."""
    return reports.latest_runs(runs(t)).select("run_id", "source", "status")


@query(f"""
    WITH runs AS ({RUNS_SQL}),
         latest AS (SELECT * FROM runs
                    QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1)
    SELECT CASE WHEN bool_or(status <> 'success') THEN 'FAILED' ELSE 'SUCCESS' END AS overall,
           string_agg(source || ': ' || status, ', ' ORDER BY started_at DESC, run_id DESC) AS breakdown
    FROM latest WHERE started_at >= (SELECT max(started_at) FROM runs) - INTERVAL 1 DAY""")
def latest_status(t):
    """One failed source fails the whole; the breakdown lists the newest first."""
    return reports.latest_run_status(runs(t))


@query(f"""
    SELECT row_number() OVER (ORDER BY started_at DESC, run_id DESC) AS place, run_id FROM ({RUNS_SQL})""")
def run_history(t):
    """The whole history, newest first, each run with its place in it."""
    order = [F.desc("started_at"), F.desc("run_id")]
    return reports.with_place(runs(t).select("started_at", "run_id"), *order).select("place", "run_id")


LABELLED_SQL = f"""
    SELECT *, CASE category WHEN 'bi' THEN 'BI' WHEN 'ml' THEN 'ML' WHEN 'devops' THEN 'DevOps'
              ELSE upper(category[1]) || lower(category[2:]) END AS category_label
    FROM ({SKILL_DEMAND_SQL}) WHERE all_time_postings_count > 0"""


@query(f"""
    SELECT skill_name, category_label, all_time_postings_count FROM ({LABELLED_SQL})
    ORDER BY all_time_postings_count DESC, skill_name LIMIT 15""")
def top_skills(t):
    """The fifteen skills with most documents, matched ones only."""
    return reports.top_skills(document_demand(t)).select(
        "skill_name", "category_label", "all_time_postings_count"
    )


@query(f"""
    SELECT skill_name, category_label, all_time_postings_count FROM ({LABELLED_SQL})
    WHERE category_label = 'Fr' ORDER BY all_time_postings_count DESC, skill_name LIMIT 2""")
def top_skills_of_category(t):
    """The two leading skills of one category."""
    return reports.top_skills(document_demand(t), 2, "Fr").select(
        "skill_name", "category_label", "all_time_postings_count"
    )


@query(f"SELECT DISTINCT category_label FROM ({LABELLED_SQL})")
def category_list(t):
    """Labels of the categories that have a match."""
    return reports.categories(document_demand(t))


@query(f"""
    SELECT row_number() OVER (ORDER BY region = 'Unspecified' DESC, postings_count, region) AS place,
           region, postings_count
    FROM ({REGION_DEMAND_SQL})""")
def region_ranking(t):
    """The unspecified region pinned first, the others by ascending count."""
    pinned = F.desc(F.col("region") == "Unspecified")
    ranked = reports.region_ranking(customer_region_demand(t))
    return reports.with_place(ranked, pinned, F.asc("postings_count"), F.asc("region")).select(
        "place", "region", "postings_count"
    )


def _daily(t):
    return t.events.groupBy(
        F.to_date("ts").alias("snapshot_date"), F.concat("event_type", F.lit("-"), (F.col("user_id") % 10)).alias("skill_name")
    ).agg(F.count(F.lit(1)).alias("postings_count"))


@query("""
    WITH daily AS (SELECT ts::DATE AS snapshot_date, event_type || '-' || (user_id % 10) AS skill_name,
                          count(*) AS postings_count FROM events GROUP BY ALL),
         top AS (SELECT skill_name FROM daily GROUP BY skill_name
                 ORDER BY sum(postings_count) DESC, skill_name LIMIT 8)
    SELECT snapshot_date, skill_name, postings_count FROM daily
    WHERE skill_name IN (SELECT skill_name FROM top)
      AND (SELECT count(DISTINCT snapshot_date) FROM daily) >= 2""")
def trend(t):
    """Daily counts of the eight leading skills, given at least two days."""
    daily = _daily(t)
    demand = daily.groupBy("skill_name").agg(
        F.sum("postings_count").alias("all_time_postings_count")
    )
    return reports.trend(daily, demand).select("snapshot_date", "skill_name", "postings_count")


def _orders_fact(t):
    """Orders as postings: open ones are active, high priorities have no company."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.when(~urgent, F.col("o_custkey").cast("string")).alias("company_id"),
        F.col("o_orderpriority").alias("title"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("location"),
        F.when(F.col("o_totalprice") > 100000, F.concat(F.lit("/o/"), "o_orderkey")).alias("posting_url"),
        (F.col("o_orderstatus") == "O").alias("is_active"),
    )


@query(f"""
    WITH latest AS (SELECT * FROM ({RUNS_SQL})
                    QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1)
    SELECT count(*) AS total_postings, count(*) FILTER (WHERE o_orderstatus = 'O') AS active_postings,
           count(DISTINCT CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' THEN o_custkey END)
               AS companies_hiring,
           (SELECT count(DISTINCT p_brand) FROM part) AS skills_tracked,
           (SELECT CASE WHEN bool_or(status <> 'success') THEN 'FAILED' ELSE 'SUCCESS' END FROM latest
            WHERE started_at >= (SELECT max(started_at) FROM latest) - INTERVAL 1 DAY) AS last_run
    FROM orders""")
def headline(t):
    """Totals, companies hiring, skills tracked and the last run on one row."""
    brands = t.part.select(F.col("p_brand").alias("skill_id"))
    return reports.headline(_orders_fact(t), brands, reports.latest_run_status(runs(t)))


@query("""
    SELECT o_orderpriority AS title, coalesce(c_name, 'Unspecified') AS company_name,
           coalesce(nullif(o_orderpriority, '5-LOW'), 'Unspecified') AS location,
           CASE WHEN o_totalprice > 100000 THEN '/o/' || o_orderkey ELSE '' END AS posting_url
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderpriority <> '1-URGENT'
    WHERE o_orderstatus = 'O'""")
def listing(t):
    """Active orders with their customer, gaps filled."""
    companies = t.customer.select(
        F.col("c_custkey").cast("string").alias("company_id"), F.col("c_name").alias("company_name")
    )
    return reports.active_listing(_orders_fact(t), companies)
