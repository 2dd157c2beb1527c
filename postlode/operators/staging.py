"""Flatten each source's payloads onto the common posting shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.functions.text import blank_to_null, clean_tags
from postlode.operators.landing import with_payload


def _parsed(raw: DataFrame, schema) -> DataFrame:
    return with_payload(raw, schema).select("job_id", "p", "first_seen_at", "last_seen_at")


def salary(text) -> F.Column:
    """Text to a number; ``0`` means unknown and bad text fails."""
    return F.nullif(text, F.lit("0")).cast(schemas.SALARY)


def stage_source_a(raw: DataFrame) -> DataFrame:
    """Source A lists remote jobs only; its location is not an office. It has no categories."""
    return _parsed(raw, schemas.SOURCE_A_PAYLOAD).select(
        "job_id",
        F.lit(fixed.SOURCE_A).alias("source"),
        F.col("p.position").alias("title"),
        F.col("p.company").alias("company_name"),
        blank_to_null("p.location").alias("location"),
        F.lit(True).alias("is_remote"),
        clean_tags("p.tags").alias("tags"),
        F.col("p.description").alias("description"),
        F.col("p.url").alias("posting_url"),
        salary(F.col("p.salary_min")).alias("salary_min"),
        salary(F.col("p.salary_max")).alias("salary_max"),
        F.timestamp_seconds(F.col("p.epoch").cast("bigint")).alias("posted_at"),
        F.lit(None).cast("string").alias("source_category"),
        "first_seen_at",
        "last_seen_at",
    )


def stage_source_b(raw: DataFrame) -> DataFrame:
    """Source B gives its salary as free text, which is not parsed; its dates are UTC."""
    return _parsed(raw, schemas.SOURCE_B_PAYLOAD).select(
        "job_id",
        F.lit(fixed.SOURCE_B).alias("source"),
        F.col("p.title").alias("title"),
        F.col("p.company_name").alias("company_name"),
        blank_to_null("p.candidate_required_location").alias("location"),
        F.lit(True).alias("is_remote"),
        clean_tags("p.tags").alias("tags"),
        F.col("p.description").alias("description"),
        F.col("p.url").alias("posting_url"),
        F.lit(None).cast(schemas.SALARY).alias("salary_min"),
        F.lit(None).cast(schemas.SALARY).alias("salary_max"),
        F.col("p.publication_date").cast("timestamp").alias("posted_at"),
        F.nullif(F.col("p.category"), F.lit("")).alias("source_category"),
        "first_seen_at",
        "last_seen_at",
    )
