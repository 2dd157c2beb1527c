"""Column contracts of the raw tables, payloads, seeds and published models."""

from __future__ import annotations

from pyspark.sql import types as T


# Salaries arrive as text of any precision; 28 whole and 10 fraction digits.
SALARY = T.DecimalType(38, 10)

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "salary": SALARY,
    "pct1": T.DecimalType(38, 1),
    "pct2": T.DecimalType(38, 2),
    "strings": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema; needs no session, so modules load without one."""
    fields = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_POSTINGS = _struct(
    "job_id string, payload string, source string, first_seen_at timestamp, last_seen_at timestamp"
)
LOAD_RUNS = _struct(
    "run_id string, source string, records_fetched int, records_upserted int, "
    "started_at timestamp, finished_at timestamp, status string, error_message string"
)

# Payload fields the models read. Every scalar is read as text and cast later,
# so a bad value fails with its own message and not as a silent null.
SOURCE_A_PAYLOAD = _struct(
    "id string, slug string, epoch string, company string, position string, location string, "
    "tags strings, description string, url string, salary_min string, salary_max string"
)
SOURCE_B_PAYLOAD = _struct(
    "id string, url string, title string, company_name string, category string, "
    "tags strings, publication_date string, candidate_required_location string, "
    "description string"
)

# Payload fields the landing rules look at.
SOURCE_A_LANDING = _struct(
    "id string, slug string, position string, company string, location string, "
    "description string, tags strings"
)
SOURCE_B_LANDING = _struct("id string, category string")

STAGED = _struct(
    "job_id string, source string, title string, company_name string, location string, "
    "is_remote boolean, tags strings, description string, posting_url string, "
    "salary_min salary, salary_max salary, posted_at timestamp, "
    "source_category string, first_seen_at timestamp, last_seen_at timestamp"
)
UNIFIED = _struct(
    "job_id string, source string, title string, company_name string, location string, "
    "source_location string, is_remote boolean, tags strings, description string, "
    "posting_url string, salary_min salary, salary_max salary, "
    "posted_at timestamp, source_category string, first_seen_at timestamp, last_seen_at timestamp"
)

DIM_COMPANY = _struct("company_id string, company_name string")
DIM_SKILL = _struct("skill_id string, skill_name string, category string, match_keyword string")
FACT = _struct(
    "job_id string, company_id string, source string, title string, location string, "
    "is_remote boolean, salary_min salary, salary_max salary, "
    "posted_at timestamp, posting_url string, first_seen_at timestamp, last_seen_at timestamp, "
    "is_active boolean"
)
# The bridges are stored with the posting's activity beside each pair, so that
# the demand marts need no join back to the fact. Readers see the pair only.
BRIDGE_SKILL = _struct("job_id string, skill_id string")
BRIDGE_SKILL_STORED = _struct("job_id string, skill_id string, is_active boolean")
BRIDGE_REGION = _struct("job_id string, region string")
BRIDGE_REGION_STORED = _struct("job_id string, region string, is_active boolean")
SKILL_DEMAND = _struct(
    "skill_id string, skill_name string, category string, postings_count bigint, "
    "pct_of_active_postings pct2, all_time_postings_count bigint, "
    "pct_of_all_postings pct2"
)
REGION_DEMAND = _struct(
    "region string, postings_count bigint, pct_of_active_postings pct1"
)
SKILL_DEMAND_DAILY = _struct(
    "snapshot_date date, skill_id string, skill_name string, category string, "
    "postings_count bigint, pct_of_active_postings pct2"
)
PIPELINE_RUNS = _struct(
    "run_id string, source string, records_fetched int, records_upserted int, "
    "started_at timestamp, finished_at timestamp, duration_seconds double, "
    "status string, error_message string"
)

SKILL_SEED = _struct("skill_name string, category string, match_keyword string")
REGION_SEED = _struct("match_keyword string, region string")
TRANSLATION_SEED = _struct("source_location string, location_en string")

CHECK_RESULTS = _struct("check string, severity string, failures bigint, status string")
