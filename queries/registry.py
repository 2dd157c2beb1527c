"""Registration of queries, and readers of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.params import Params
from postlode.session import use_result_settings
from postlode.sources.small import spread_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The events end on 2024-01-30; every query measures time against this instant.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
AS_OF_EPOCH = int(AS_OF.timestamp())
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
PARAMS = Params(AS_OF)

# Tables of long texts and their keys.
TEXTS = {"documents": "doc_id", "pages": "page_id"}


def query(sql: str):
    """Register a query under its function's name, beside the SQL that gives the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Tables(use_result_settings(spark), sf_dir))

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        ORACLES[function.__name__] = sql
        return run

    return register


class Tables:
    """The driver's parquet tables; their zoneless timestamps are read as UTC instants."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        if name in TEXTS:
            df = spread_scan(df, TEXTS[name])
        zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def micros(c: str) -> Column:
    return F.unix_micros(c)


def as_double(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("double") for n in names}


def corrupt(c: Column) -> Column:
    """UTF-8 bytes read as Latin-1: the damage the repair undoes."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def values_sql(rows: list[tuple]) -> str:
    def one(v) -> str:
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + ")"


def share_sql(part: str, whole: str, digits: int) -> str:
    """Percentage rounded half up in integers; DuckDB's decimal division is a double."""
    scale = 100 * 10**digits
    return (
        f"(CASE WHEN {whole} = 0 THEN NULL ELSE "
        f"((2 * {scale} * {part} + {whole}) // (2 * {whole})) / {10**digits}.0 END)::DOUBLE"
    )


# A character that cannot be part of a word, in DuckDB's pattern language.
NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


def keywords_found_sql(texts: list[str], keywords: list[str]) -> str:
    """List of the keywords that occur as whole words in any of the texts; NULL for the others."""

    def found(keyword: str) -> str:
        pattern = f"'(?i)(^|{NOT_WORD}){keyword}({NOT_WORD}|$)'"
        test = " OR ".join(f"coalesce(regexp_matches({x}, {pattern}), FALSE)" for x in texts)
        return f"CASE WHEN {test} THEN '{keyword}' END"

    return f"[{', '.join(map(found, keywords))}]"
