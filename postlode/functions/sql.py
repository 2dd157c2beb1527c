"""The text macros as SQL functions, for callers who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from postlode import fixed_values as fixed

# The tests of ``functions.text.is_mojibake``, the cheap one first.
_DAMAGED = f"octet_length(c) <> length(c) and c rlike r'{fixed.MOJIBAKE_SIGNATURE}'"

SQL_FUNCTIONS = {
    "clean_text": (
        "STRING",
        f"nullif(trim(regexp_replace(c, r'{fixed.WHITESPACE}+', ' ')), '')",
    ),
    "is_mojibake": ("BOOLEAN", _DAMAGED),
    "is_non_latin": (
        "BOOLEAN",
        f"c rlike r'{fixed.NON_ASCII}' and not c rlike r'{fixed.LATIN_LETTER}'",
    ),
    "null_if_mojibake": (
        "STRING",
        f"case when not ({_DAMAGED}) then c end",
    ),
    "surrogate_key": ("STRING", "md5(lower(trim(c)))"),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create the five macros as temporary SQL functions; Catalyst inlines them."""
    for name, (returns, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS {returns} RETURN {body}"
        )
