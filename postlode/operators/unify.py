"""All sources as one table of relevant postings with clean text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.functions.text import (
    clean_text,
    is_non_latin,
    null_if_mojibake,
    strip_trailing_separators,
)
from postlode.operators.landing import in_categories


def union_sources(staged: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL matched by column name; a source that lacks a column fails."""
    return reduce(DataFrame.unionByName, staged)


def in_scope(
    category: Column,
    title: Column,
    categories: Sequence[str] = fixed.TECH_CATEGORIES,
    title_pattern: str = fixed.TITLE_PATTERN,
) -> Column:
    """Titled, and either in an allowed category or with a role word in the title.

    A missing category falls through to the title test, and so does one that is
    not allowed. Role words are substrings, any case.
    """
    by_title = title.rlike(f"(?i){title_pattern}")
    return title.isNotNull() & (in_categories(category, categories) | by_title)


def clean_location(location: Column) -> Column:
    """Mojibake to NULL, then trailing separators off, then spaces collapsed."""
    return clean_text(strip_trailing_separators(null_if_mojibake(location)))


def translate_location(df: DataFrame, translations: DataFrame) -> DataFrame:
    """Add ``location``: the translation, NULL for other non-Latin text, else the source text."""
    t = translations.select("source_location", "location_en")
    source = F.col("source_location")
    return (
        df.join(t, "source_location", "left")
        .withColumn(
            "location",
            F.when(F.col("location_en").isNotNull(), F.col("location_en"))
            .when(is_non_latin(source), None)
            .otherwise(source),
        )
        .drop("location_en")
    )


def unify(
    staged: Sequence[DataFrame],
    translations: DataFrame,
    categories: Sequence[str] = fixed.TECH_CATEGORIES,
    title_pattern: str = fixed.TITLE_PATTERN,
) -> DataFrame:
    """Relevant postings of every source on one shape, one row per posting."""
    kept = union_sources(staged).where(
        in_scope(F.col("source_category"), F.col("title"), categories, title_pattern)
    )
    cleaned = kept.withColumns(
        {
            "title": F.trim("title"),
            "company_name": clean_text(null_if_mojibake("company_name")),
            "source_location": clean_location(F.col("location")),
            "is_remote": F.coalesce("is_remote", F.lit(False)),
        }
    )
    return translate_location(cleaned, translations).select(*schemas.UNIFIED.names)
