"""A third source, with fields that vary by record, from its files to the common shape."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlode import schemas
from postlode.functions.text import blank_to_null
from postlode.functions.variant import first_value, with_variant
from postlode.operators.unify import unify
from postlode.plans.ingest import SourceSpec, raw_table, run_source
from postlode.sources.dumps import read_json_lines
from postlode.sources.seeds import seed_table
from postlode.sources.tables import Warehouse
from queries.files import folder
from queries.registry import AS_OF, query

NAME = "turns"
# Where a record may hold a field, first come first served.
PATHS = {
    "title": ("$.role", "$.meta.role", "$.roles[0]"),
    "category": ("$.category", "$.meta.labels[0].name"),
    "place": ("$.place", "$.place.city"),
    "pay": ("$.pay", "$.pay.low"),
    "text": ("$.text", "$.body.parts[0]"),
}


def stage_turns(raw: DataFrame) -> DataFrame:
    """Records of any of the source's forms on the shape that all sources share."""
    return with_variant(raw).select(
        "job_id", F.lit(NAME).alias("source"), first_value(PATHS["title"]).alias("title"),
        F.lit("Tern &  Co ").alias("company_name"),
        blank_to_null(first_value(PATHS["place"])).alias("location"), F.lit(None).cast("boolean").alias("is_remote"),
        F.lit(None).cast("array<string>").alias("tags"), first_value(PATHS["text"]).alias("description"),
        F.lit(None).cast("string").alias("posting_url"),
        F.nullif(first_value(PATHS["pay"], "decimal(38,10)"), F.lit(0)).cast(schemas.SALARY).alias("salary_min"),
        F.lit(None).cast(schemas.SALARY).alias("salary_max"), F.lit(None).cast("timestamp").alias("posted_at"),
        first_value(PATHS["category"]).alias("source_category"), "first_seen_at", "last_seen_at",
    )


SOURCE = SourceSpec(
    name=NAME,
    read=read_json_lines,
    fields=T.StructType().add("id", "string").add("meta", "string"),
    keep=lambda: F.coalesce("p.id", F.get_json_object("p.meta", "$.key")).isNotNull(),
    key=lambda: F.concat(F.lit(f"{NAME}_"), F.coalesce("p.id", F.get_json_object("p.meta", "$.key"))),
    stage=stage_turns,
)


def write_lines(t, path: str) -> str:
    """Each turn as a line in one of three forms, by its number; and lines without a key, or blank."""
    key = F.concat_ws("-", "conv_id", "turn")
    category = F.when(F.col("role") == "assistant", "Software Development").otherwise("Sales")
    flat = F.struct(
        key.alias("id"), "role", category.alias("category"), F.lit("Berlin, ").alias("place"),
        F.col("turn").alias("pay"), "text",
    )
    nested = F.struct(
        F.struct(
            key.alias("key"), F.col("role").alias("role"), F.array(F.struct(category.alias("name"))).alias("labels")
        ).alias("meta"),
        F.struct(F.lit("مسقط").alias("city")).alias("place"),
        F.struct((F.col("turn") + 0.5).alias("low")).alias("pay"), F.struct(F.array("text").alias("parts")).alias("body"),
    )
    listed = F.struct(
        key.alias("id"), F.array(F.concat(F.lit(" data "), "role")).alias("roles"), F.lit("").alias("place"),
        F.lit("unknown").alias("pay"), F.col("text").alias("text"),
    )
    form = F.pmod("turn", F.lit(3))
    line = F.when(form == 0, F.to_json(flat)).when(form == 1, F.to_json(nested)).otherwise(F.to_json(listed))
    lines = t.conversations.select(line.alias("value"))
    others = t.spark.createDataFrame([(" ",), ('{"meta": {"role": "assistant"}}',), ('{"text": "no key"}',)], "value string")
    lines.unionByName(others).write.text(path)
    return path


@query("""
    SELECT 'turns_' || conv_id || '-' || turn AS job_id, 'turns' AS source,
           CASE WHEN turn % 3 = 2 THEN 'data ' || role ELSE role END AS title, 'Tern & Co' AS company_name,
           CASE turn % 3 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Muscat' END AS location, FALSE AS is_remote,
           CASE turn % 3 WHEN 0 THEN nullif(turn, 0)::DOUBLE WHEN 1 THEN turn + 0.5::DOUBLE END AS salary_min,
           CASE WHEN turn % 3 < 2 THEN 'Software Development' END AS source_category, md5(text) AS text_md5
    FROM conversations WHERE turn % 3 = 2 OR role = 'assistant'""")
def third_source(t):
    """Turns in records of three forms landed, read as VARIANT, staged and unified; the scope rule drops the others."""
    warehouse = Warehouse(t.spark, folder(t.spark, "warehouse"))
    run_source(warehouse, SOURCE, write_lines(t, folder(t.spark, "lines")), clock=lambda: AS_OF)
    places = seed_table(t.spark, [("مسقط", "Muscat")], schemas.TRANSLATION_SEED)
    unified = unify([SOURCE.stage(raw_table(warehouse, NAME).read())], places)
    return unified.select(
        "job_id", "source", "title", "company_name", "location", "is_remote",
        F.col("salary_min").cast("double").alias("salary_min"), "source_category", F.md5("description").alias("text_md5"),
    )
