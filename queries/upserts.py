"""Upserts by key and daily history."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from postlode.operators.upsert import latest_per_key, replace_by_key, upsert
from queries.registry import AS_OF_SQL, AS_OF, micros, query

CUT = datetime(2024, 1, 16, tzinfo=timezone.utc)
CUT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"


@query("""
    SELECT user_id, event_id, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_in_batch(t):
    """The last row of each key in a batch."""
    latest = latest_per_key(t.events, ["user_id"], F.col("ts"), F.col("event_id"))
    return latest.select("user_id", "event_id", "value", "props")


@query(f"""
    WITH before AS (
        SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, arg_max(props, (ts, event_id)) AS props,
               'early' AS origin
        FROM events WHERE ts < {CUT_SQL} GROUP BY user_id),
    batch AS (
        SELECT user_id, arg_max(props, (ts, event_id)) AS props
        FROM events WHERE ts >= {CUT_SQL} GROUP BY user_id)
    SELECT coalesce(t.user_id, b.user_id) AS user_id, coalesce(b.props, t.props) AS payload,
           coalesce(t.origin, 'late') AS source,
           epoch_us(coalesce(t.first_ts, {AS_OF_SQL})) AS first_seen_us,
           epoch_us(CASE WHEN b.user_id IS NULL THEN t.last_ts ELSE {AS_OF_SQL} END) AS last_seen_us
    FROM before t FULL OUTER JOIN batch b ON t.user_id = b.user_id""")
def upsert_first_last_seen(t):
    """A month's second half upserted into its first: update, keep and insert."""
    early, late = t.events.where(F.col("ts") < F.lit(CUT)), t.events.where(F.col("ts") >= F.lit(CUT))
    order = F.struct("ts", "event_id")
    target = early.groupBy("user_id").agg(
        F.max_by("props", order).alias("payload"),
        F.lit("early").alias("source"),
        F.min("ts").alias("first_seen_at"),
        F.max("ts").alias("last_seen_at"),
    )
    batch = latest_per_key(late, ["user_id"], F.col("ts"), F.col("event_id")).select(
        "user_id", F.col("props").alias("payload"), F.lit("late").alias("source")
    )
    merged = upsert(target, batch, AS_OF, key="user_id")
    return merged.select(
        "user_id", "payload", "source",
        micros("first_seen_at").alias("first_seen_us"),
        micros("last_seen_at").alias("last_seen_us"),
    )


@query("""
    WITH morning AS (
        SELECT ts::DATE AS snapshot_date, event_type, count(*) AS postings_count
        FROM events WHERE value < 40 GROUP BY ALL),
    rerun AS (
        SELECT ts::DATE AS snapshot_date, event_type, count(*) AS postings_count
        FROM events
        WHERE ts::DATE = (SELECT max(ts::DATE) FROM events) AND event_type <> 'error' GROUP BY ALL)
    SELECT * FROM rerun
    UNION ALL
    SELECT * FROM morning m
    WHERE NOT EXISTS (SELECT 1 FROM rerun r
                      WHERE r.snapshot_date = m.snapshot_date AND r.event_type = m.event_type)""")
def daily_snapshot(t):
    """A day's rerun replaces its rows by key; a key it no longer has keeps its earlier row."""

    def counts(df):
        return df.groupBy(F.to_date("ts").alias("snapshot_date"), "event_type").agg(
            F.count(F.lit(1)).alias("postings_count")
        )

    today = t.events.agg(F.max(F.to_date("ts"))).scalar()
    history = counts(t.events.where("value < 40"))
    rerun = counts(t.events.where((F.to_date("ts") == today) & (F.col("event_type") != "error")))
    return replace_by_key(history, rerun, ["snapshot_date", "event_type"])
