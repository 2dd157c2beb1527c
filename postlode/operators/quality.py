"""Data checks. Each names the rows that break a rule; no rows means it holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode.functions.text import is_mojibake, is_non_latin
from postlode.params import Params

ERROR, WARN = "error", "warn"


class QualityError(RuntimeError):
    """Raised when a check of error severity has failures."""


@dataclass(frozen=True)
class Check:
    """A named rule: its offending rows and how many failures they stand for."""

    name: str
    rows: DataFrame
    severity: str = ERROR
    failures: str = "count(1)"

    def summary(self) -> DataFrame:
        count = F.coalesce(F.expr(self.failures), F.lit(0)).cast("bigint")
        return self.rows.agg(count.alias("failures")).select(
            F.lit(self.name).alias("check"), F.lit(self.severity).alias("severity"), "failures"
        )


@dataclass(frozen=True)
class Rule:
    """A condition that no row of a table may meet."""

    name: str
    violated: Column
    severity: str = ERROR


@dataclass(frozen=True)
class RowChecks:
    """All rules about single rows of one table, counted in a single pass over it."""

    df: DataFrame
    rules: Sequence[Rule]

    def summary(self) -> DataFrame:
        counted = self.df.agg(
            *[F.count_if(r.violated).alias(f"_{i}") for i, r in enumerate(self.rules)]
        )
        rows = [
            F.struct(
                F.lit(r.name).alias("check"),
                F.lit(r.severity).alias("severity"),
                F.col(f"_{i}").alias("failures"),
            )
            for i, r in enumerate(self.rules)
        ]
        return counted.select(F.inline(F.array(*rows)))


# --- rules: offending rows ---------------------------------------------------


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count. NULLs are ignored."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their count. NULLs pass."""
    return (
        df.where(not_accepted(column, values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values that no parent has, with the number of child rows. NULLs pass.

    Child rows are counted per value before the join, so a value that most rows
    share crosses the network as one row per task.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def broken(df: DataFrame, rule_violated: Column) -> DataFrame:
    return df.where(rule_violated)


def salary_reversed() -> Column:
    """Both salaries present and the upper one below the lower one."""
    return F.col("salary_max") < F.col("salary_min")


def salary_out_of_order(fact: DataFrame) -> DataFrame:
    return broken(fact, salary_reversed()).select("job_id", "salary_min", "salary_max")


def share_impossible() -> Column:
    pct = F.col("pct_of_active_postings")
    return (pct < 0) | (pct > 100)


def share_out_of_range(demand: DataFrame) -> DataFrame:
    return broken(demand, share_impossible()).select("skill_id", "pct_of_active_postings")


CHECKED_TEXTS = ("title", "company_name", "location")


def text_damaged(columns: Sequence[str] = CHECKED_TEXTS) -> Column:
    """Any of the texts still has mojibake that the repair could not mend."""
    return reduce(lambda a, b: a | b, [F.coalesce(is_mojibake(c), F.lit(False)) for c in columns])


def residual_mojibake(
    staged: Sequence[DataFrame], columns: Sequence[str] = CHECKED_TEXTS
) -> DataFrame:
    """The damaged rows of all staging tables."""
    return reduce(
        DataFrame.unionByName,
        [s.where(text_damaged(columns)).select("job_id", *columns) for s in staged],
    )


def untranslated_locations(unified: DataFrame) -> DataFrame:
    """Non-Latin source locations without a translation; each is one to add."""
    return (
        unified.where(F.col("location").isNull() & is_non_latin("source_location"))
        .select("source_location").distinct()
    )


def locations_without_region(
    regions: DataFrame, fact: DataFrame, default: str = fixed.UNSPECIFIED
) -> DataFrame:
    """Locations that no region keyword matched, except those that name no place."""
    named = fact.where(
        F.col("location").isNotNull() & ~F.col("location").rlike(fixed.PLACELESS_LOCATION)
    )
    unmatched = regions.where(F.col("region") == default).select("job_id")
    return named.join(unmatched, "job_id", "left_semi").select("location").distinct()


# --- checks by rule ----------------------------------------------------------


def unique_check(table: str, df: DataFrame, column: str) -> Check:
    return Check(f"unique_{table}_{column}", duplicates(df, column))


def not_null_rules(table: str, columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"not_null_{table}_{c}", F.col(c).isNull()) for c in columns]


def accepted_rule(table: str, column: str, values: Sequence[str]) -> Rule:
    return Rule(f"accepted_values_{table}_{column}", not_accepted(column, values))


def relationship_check(
    table: str, df: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> Check:
    return Check(
        f"relationships_{table}_{column}",
        orphans(df, column, parent, parent_column),
        failures="sum(n_records)",
    )


def freshness(source: str, raw: DataFrame, params: Params) -> DataFrame:
    """pass, warn or error by the age of the newest row; an empty source is an error."""
    newest = raw.agg(F.max("last_seen_at").alias("newest"))
    stale = F.lit(params.as_of - timedelta(hours=params.freshness_error_hours))
    old = F.lit(params.as_of - timedelta(hours=params.freshness_warn_hours))
    status = (
        F.when(F.col("newest").isNull() | (F.col("newest") < stale), "error")
        .when(F.col("newest") < old, "warn")
        .otherwise("pass")
    )
    return newest.select(F.lit(source).alias("source"), "newest", status.alias("status"))


# --- running -----------------------------------------------------------------


def run_checks(checks: Iterable[Check | RowChecks]) -> DataFrame:
    """One row per check: name, severity, failures, status. All run as one job.

    A check made of several tables' parts adds them up.
    """
    parts = reduce(DataFrame.unionByName, [c.summary() for c in checks])
    summaries = parts.groupBy("check", "severity").agg(F.sum("failures").alias("failures"))
    failed = F.when(F.col("severity") == ERROR, F.lit("error")).otherwise(F.lit("warn"))
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(failed)
    return summaries.withColumn("status", status)


def enforce(results: DataFrame) -> list:
    """Collect the results (one row per check) and stop the run on any error."""
    rows = results.orderBy("check").collect()
    errors = [f"{r['check']}: {r['failures']}" for r in rows if r["status"] == "error"]
    if errors:
        raise QualityError("failed checks: " + ", ".join(errors))
    return rows
