"""Data checks: each lists what breaks its rule."""

from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode.operators import quality
from postlode.operators.quality import WARN, Check, RowChecks, not_null_rules
from postlode.operators.staging import stage_source_a, stage_source_b
from queries.landing import PLACES, POSTINGS_A_SQL, POSTINGS_B_SQL, postings_a, raw_a, raw_b
from queries.models import (
    PLACES_SQL,
    REGION_PAIRS_SQL,
    UNIFIED_SQL,
    customer_places,
    regions,
    region_rows,
    unified,
)
from queries.registry import PARAMS, corrupt, micros, query


@query("""
    SELECT o_custkey AS value, count(*) AS n_records FROM orders
    WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""")
def check_unique(t):
    """Keys that occur more than once."""
    return quality.duplicates(t.orders, "o_custkey")


@query("""
    SELECT 'not_null_documents_' || c AS "check", 'error' AS severity, n AS failures
    FROM (SELECT count(*) FILTER (WHERE nullif(lang, 'en') IS NULL) AS lang,
                 count(*) FILTER (WHERE text IS NULL) AS text,
                 count(*) FILTER (WHERE nullif(source, 'src1') IS NULL) AS source FROM documents)
    UNPIVOT (n FOR c IN (lang, text, source))""")
def check_not_null(t):
    """NULLs of several columns counted in one pass."""
    gaps = t.documents.select(
        F.nullif("lang", F.lit("en")).alias("lang"), "text",
        F.nullif("source", F.lit("src1")).alias("source"),
    )
    return RowChecks(gaps, not_null_rules("documents", ["lang", "text", "source"])).summary()


@query("""
    SELECT event_type AS value, count(*) AS n_records FROM events
    WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type""")
def check_accepted(t):
    """Values outside the allowed list; NULL would pass."""
    return quality.unaccepted(t.events, "event_type", ["view", "click", "purchase"])


@query("""
    SELECT l_suppkey AS value, count(*) AS n_records FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY l_suppkey""")
def check_relationships(t):
    """Line items whose supplier is not among those in credit."""
    return quality.orphans(
        t.lineitem, "l_suppkey", t.supplier.where("s_acctbal >= 0"), "s_suppkey"
    )


@query("""
    SELECT event_id::VARCHAR AS job_id, value AS salary_min, user_id::DOUBLE AS salary_max
    FROM events WHERE value IS NOT NULL AND user_id < value""")
def check_salary_range(t):
    """An upper bound below its lower bound."""
    return quality.salary_out_of_order(
        t.events.select(
            F.col("event_id").cast("string").alias("job_id"), F.col("value").alias("salary_min"),
            F.col("user_id").cast("double").alias("salary_max"),
        )
    )


@query("""
    SELECT c_custkey::VARCHAR AS skill_id, c_acctbal / 50 AS pct_of_active_postings
    FROM customer WHERE c_acctbal / 50 < 0 OR c_acctbal / 50 > 100""")
def check_percentages(t):
    """Shares outside 0 to 100."""
    return quality.share_out_of_range(
        t.customer.select(
            F.col("c_custkey").cast("string").alias("skill_id"),
            (F.col("c_acctbal") / 50).alias("pct_of_active_postings"),
        )
    )


@query(f"""
    SELECT job_id, title FROM (({POSTINGS_A_SQL}) UNION ALL ({POSTINGS_B_SQL}))
    WHERE source = 'remoteok' OR regexp_matches(title, '[\\x{{C2}}-\\x{{F4}}][\\x{{80}}-\\x{{BF}}]')""")
def check_mojibake(t):
    """Postings of any source with damaged text: all of source A, damaged again after its repair."""
    a = stage_source_a(raw_a(t)).withColumn("company_name", corrupt(F.col("company_name")))
    return quality.residual_mojibake([a, stage_source_b(raw_b(t))]).select("job_id", "title")


@query(f"""
    SELECT DISTINCT source_location FROM ({UNIFIED_SQL.replace("'Tokyo, Japan'", "NULL")})
    WHERE location IS NULL AND source_location IS NOT NULL""")
def check_translated(t):
    """Foreign-script locations that lack a translation."""
    untranslated = unified(t).withColumn(
        "location", F.nullif(F.col("location"), F.lit("Tokyo, Japan"))
    )
    return quality.untranslated_locations(untranslated)


@query(f"""
    SELECT DISTINCT p.location FROM ({PLACES_SQL}) p JOIN ({REGION_PAIRS_SQL}) b USING (job_id)
    WHERE b.region = 'Unspecified' AND p.location IS NOT NULL""")
def check_has_region(t):
    """Locations that no region keyword matched."""
    places = customer_places(t)
    pairs = region_rows(places, regions(t), default=fixed.UNSPECIFIED)
    return quality.locations_without_region(pairs, places)


@query("""
    SELECT 'events' AS source, epoch_us(max(ts)) AS newest_us,
           CASE WHEN max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 72 HOUR THEN 'error'
                WHEN max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 30 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM events
    UNION ALL
    SELECT 'orders', epoch_us(max(o_orderdate)), 'error' FROM orders""")
def check_freshness(t):
    """Age of the newest row of each source against two limits."""
    events = t.events.withColumn("last_seen_at", F.col("ts"))
    orders = t.orders.withColumn("last_seen_at", F.col("o_orderdate"))
    both = quality.freshness("events", events, PARAMS).unionByName(
        quality.freshness("orders", orders, PARAMS)
    )
    return both.select("source", micros("newest").alias("newest_us"), "status")


@query("""
    WITH orphans AS (SELECT count(*) AS n FROM lineitem
                     WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)),
         repeated AS (SELECT count(*) AS n FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)),
         odd AS (SELECT count(DISTINCT event_type) AS n FROM events WHERE event_type NOT IN ('view', 'click'))
    SELECT "check", severity, failures, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status
    FROM (SELECT 'relationships_lineitem_l_suppkey' AS "check", 'error' AS severity, n AS failures FROM orphans
          UNION ALL SELECT 'unique_orders_o_orderkey', 'error', n FROM repeated
          UNION ALL SELECT 'event_types_known', 'warn', n FROM odd
          UNION ALL SELECT 'not_null_orders_o_orderkey', 'error', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
          UNION ALL SELECT 'not_null_orders_o_custkey', 'error', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders)""")
def check_results(t):
    """Checks of both severities run together: failures and status of each."""
    creditors = t.supplier.where("s_acctbal >= 0")
    return quality.run_checks(
        [
            quality.relationship_check("lineitem", t.lineitem, "l_suppkey", creditors, "s_suppkey"),
            quality.unique_check("orders", t.orders, "o_orderkey"),
            RowChecks(t.orders, not_null_rules("orders", ["o_orderkey", "o_custkey"])),
            Check("event_types_known", quality.unaccepted(t.events, "event_type", ["view", "click"]), WARN),
        ]
    )
