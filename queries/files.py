"""Operators that write and read files: dumps, seeds, raw tables and the run log, over files derived from the tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlode.operators.landing import payload_fields
from postlode.operators.runlog import load_runs
from postlode.operators.upsert import latest_per_key, upsert_table
from postlode.plans.ingest import SOURCE_A, raw_table, run_source
from postlode.sources.dumps import read_array_dump, read_envelope_dump
from postlode.sources.seeds import read_seed
from postlode.sources.tables import Warehouse
from queries.registry import AS_OF, AS_OF_SQL, micros, query
from queries.upserts import CUT, CUT_SQL

FILES = 8
LAST = 1 << 62


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``, or on a single machine below /tmp."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}/{name}"


def write_dumps(t, path: str, opening: str, closing: str, alone: str | None = None) -> str:
    """Every turn of ``conversations`` as a posting in one of ``FILES`` dumps between the given texts.

    With ``alone``, one more file holds just that text.
    """
    posting = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id", "turn", F.col("role").alias("position"),
        F.array(F.lit("software"), F.lit('"}], {')).alias("tags"), F.col("text").alias("description"),
    )
    place = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(FILES))
    rows = t.conversations.select(
        place.alias("file"), F.monotonically_increasing_id().alias("at"), F.concat(F.lit(","), F.to_json(posting)).alias("line")
    )
    ends = [(i, at, line) for i in range(FILES) for at, line in ((-1, opening), (LAST, closing))]
    ends += [] if alone is None else [(FILES, 0, alone)]
    lines = rows.unionByName(t.spark.createDataFrame(ends, "file long, at long, line string"))
    lines = lines.repartition("file").sortWithinPartitions("file", "at")
    lines.select("line", "file").write.partitionBy("file").text(path)
    return path


def turns(postings: DataFrame) -> DataFrame:
    """The records that have a key, with their fields."""
    fields = payload_fields("payload", "id string, conv_id bigint, turn bigint, position string, description string")
    return postings.select(fields.alias("p")).where("p.id is not null").select(
        "p.id", "p.conv_id", "p.turn", F.col("p.position").alias("role"), F.md5("p.description").alias("text_md5")
    )


TURNS_SQL = "SELECT conv_id || '-' || turn AS id, conv_id, turn, role, md5(text) AS text_md5 FROM conversations"
NOTICE = '{"legal": "terms: ]} \\"[{", "generated": 20260101}'


@query(TURNS_SQL)
def split_array_dump(t):
    """Arrays that begin with a notice, read in splits."""
    path = write_dumps(t, folder(t.spark, "arrays"), f"[{NOTICE}", "]")
    return turns(read_array_dump(t.spark, path))


@query(TURNS_SQL)
def split_envelope_dump(t):
    """Envelopes with a record without key, arrays beside and below the field, and one without the field."""
    opening = f'{{"notice": "{{[", "meta": {{"jobs": [{{"id": "no"}}]}}, "others": [{{"id": "no"}}], "jobs": [{NOTICE}'
    closing = '], "after": [{"id": "no"}, {"jobs": [{"id": "no"}]}], "end": {"a": {"b": []}}}'
    path = write_dumps(t, folder(t.spark, "envelopes"), opening, closing, '{"count": 0, "job": [{"id": "no"}]}')
    return turns(read_envelope_dump(t.spark, path))


@query(f"""
    SELECT 'remoteok' AS source, count(*)::INTEGER + {FILES} AS records_fetched, count(*)::INTEGER AS records_upserted,
           'success' AS status, FALSE AS has_error, TRUE AS in_order FROM conversations
    UNION ALL SELECT 'remoteok', 0, 0, 'failed', TRUE, TRUE""")
def source_run_log(t):
    """The log of a run that lands a dump and of one whose dump is broken."""
    warehouse = Warehouse(t.spark, folder(t.spark, "warehouse"))
    run_source(warehouse, SOURCE_A, write_dumps(t, folder(t.spark, "good"), f"[{NOTICE}", "]"))
    try:
        run_source(warehouse, SOURCE_A, write_dumps(t, folder(t.spark, "broken"), f"[{NOTICE}", ""))
    except Exception as error:
        if "malformed" not in str(error):
            raise
    return load_runs(warehouse).select(
        "source", "records_fetched", "records_upserted", "status",
        F.coalesce(F.col("error_message").contains("malformed"), F.lit(False)).alias("has_error"),
        (F.col("finished_at") >= F.col("started_at")).alias("in_order"),
    )


@query(f"""
    WITH early AS (SELECT user_id, arg_max(props, (ts, event_id)) AS props FROM events WHERE ts < {CUT_SQL} GROUP BY 1),
    late AS (SELECT user_id, arg_max(props, (ts, event_id)) AS props FROM events WHERE ts >= {CUT_SQL} GROUP BY 1)
    SELECT coalesce(e.user_id, l.user_id)::VARCHAR AS job_id, coalesce(l.props, e.props) AS payload,
           CASE WHEN e.user_id IS NULL THEN 'late' ELSE 'early' END AS source,
           epoch_us(CASE WHEN e.user_id IS NULL THEN {AS_OF_SQL} ELSE {CUT_SQL} END) AS first_seen_us,
           epoch_us(CASE WHEN l.user_id IS NULL THEN {CUT_SQL} ELSE {AS_OF_SQL} END) AS last_seen_us
    FROM early e FULL OUTER JOIN late l ON e.user_id = l.user_id""")
def raw_table_written(t):
    """A raw table made, upserted twice and read back; the second batch is written twice, as a rerun would."""
    table = raw_table(Warehouse(t.spark, folder(t.spark, "warehouse")), "events")
    table.ensure()
    late = F.col("ts") >= F.lit(CUT)
    for rows, source, now in ((~late, "early", CUT), (late, "late", AS_OF), (late, "late", AS_OF)):
        batch = latest_per_key(t.events.where(rows), ["user_id"], F.col("ts"), F.col("event_id"))
        columns = (F.col("user_id").cast("string").alias("job_id"), F.col("props").alias("payload"))
        upsert_table(table, batch.select(*columns, F.lit(source).alias("source")), now)
    return table.read().select(
        "job_id", "payload", "source",
        micros("first_seen_at").alias("first_seen_us"), micros("last_seen_at").alias("last_seen_us"),
    )


PLACES = T.StructType().add("source_location", "string").add("location_en", "string").add("rows", "long")


@query("""
    SELECT p_name || ', "' || p_type || '", 東京 ü' AS source_location, nullif(p_brand, '') AS location_en,
           count(*) AS rows FROM part GROUP BY ALL""")
def seed_csv(t):
    """A seed with quoted commas, doubled quotes and letters beyond ASCII, written and read back."""
    path = folder(t.spark, "seed")
    name = F.concat("p_name", F.lit(', "'), "p_type", F.lit('", 東京 ü'))
    rows = t.part.groupBy(name.alias("source_location"), F.col("p_brand").alias("location_en")).agg(F.count("*").alias("rows"))
    rows.write.csv(path, header=True, quote='"', escape='"', encoding="UTF-8")
    return read_seed(t.spark, path, PLACES)
