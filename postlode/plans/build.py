"""Build every model from the raw tables, layer by layer, with checks in between."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.operators import marts, quality
from postlode.operators.history import append_snapshot, snapshot
from postlode.operators.quality import (
    WARN,
    Check,
    RowChecks,
    Rule,
    accepted_rule,
    not_null_rules,
    relationship_check,
    unique_check,
)
from postlode.operators.runlog import load_runs, pipeline_runs
from postlode.operators.unify import unify
from postlode.params import Params
from postlode.plans.ingest import SOURCES, SourceSpec, raw_table
from postlode.sources.seeds import seed_table
from postlode.sources.tables import Table, Warehouse

# Published models and the columns their readers see.
MODELS = {
    "intermediate/int_jobs_unioned": schemas.UNIFIED,
    "marts/dim_company": schemas.DIM_COMPANY,
    "marts/dim_skill": schemas.DIM_SKILL,
    "marts/fact_job_postings": schemas.FACT,
    "marts/bridge_job_skill": schemas.BRIDGE_SKILL,
    "marts/bridge_job_region": schemas.BRIDGE_REGION,
    "marts/mart_skill_demand": schemas.SKILL_DEMAND,
    "marts/mart_postings_by_region": schemas.REGION_DEMAND,
    "marts/fct_skill_demand_daily": schemas.SKILL_DEMAND_DAILY,
    "marts/mart_pipeline_runs": schemas.PIPELINE_RUNS,
}


@dataclass(frozen=True)
class Seeds:
    skills: DataFrame
    regions: DataFrame
    translations: DataFrame


def default_seeds(spark) -> Seeds:
    return Seeds(
        seed_table(spark, fixed.SKILL_KEYWORDS, schemas.SKILL_SEED),
        seed_table(spark, fixed.REGION_KEYWORDS, schemas.REGION_SEED),
        seed_table(spark, fixed.LOCATION_TRANSLATIONS, schemas.TRANSLATION_SEED),
    )


def model(warehouse: Warehouse, name: str) -> DataFrame:
    """A published model by its short or full name."""
    full = next(m for m in MODELS if m == name or m.endswith("/" + name))
    return warehouse.table(full, MODELS[full]).read()


def models_exist(warehouse: Warehouse) -> bool:
    """Has a build published the marts?"""
    return all(
        warehouse.table(m, s).exists() for m, s in MODELS.items() if m.startswith("marts/")
    )


def register_views(warehouse: Warehouse) -> None:
    """Every model as a temporary view under its short name, for callers who write SQL."""
    for name in MODELS:
        model(warehouse, name).createOrReplaceTempView(name.split("/")[1])


def _publish(warehouse: Warehouse, name: str, df: DataFrame, schema=None) -> Table:
    """Write a model once; what is built on it reads the stored rows, not the plan behind them."""
    table = warehouse.table(name, schema or MODELS[name])
    table.overwrite(df)
    return table


def seed_checks(seeds: Seeds) -> list:
    skills, places, regions = seeds.skills, seeds.translations, seeds.regions
    return [
        unique_check("skill_keywords", skills, "skill_name"),
        unique_check("skill_keywords", skills, "match_keyword"),
        RowChecks(skills, not_null_rules("skill_keywords", ["skill_name", "match_keyword"])),
        unique_check("location_translations", places, "source_location"),
        RowChecks(
            places, not_null_rules("location_translations", ["source_location", "location_en"])
        ),
        RowChecks(regions, not_null_rules("region_keywords", ["match_keyword", "region"])),
    ]


def raw_checks(name: str, raw: DataFrame) -> list:
    table = f"{name}_jobs"
    return [
        unique_check(table, raw, "job_id"),
        RowChecks(raw, not_null_rules(table, ["job_id", "payload"])),
    ]


def staging_checks(name: str, raw: DataFrame, staged: DataFrame) -> list:
    """Staging parses each payload, so all its rules share one pass.

    It keeps the rows and keys of the raw table, so uniqueness is read off that.
    """
    table = f"stg_{name}_jobs"
    rules = not_null_rules(table, ["job_id", "source", "title"])
    rules.append(accepted_rule(table, "source", [name]))
    if name == fixed.SOURCE_B:
        rules += not_null_rules(table, ["source_category"])
        rules.append(accepted_rule(table, "source_category", fixed.TECH_CATEGORIES))
    rules.append(Rule("no_mojibake_in_text", quality.text_damaged(), WARN))
    return [unique_check(table, raw, "job_id"), RowChecks(staged, rules)]


def unified_checks(unified: DataFrame) -> list:
    return [
        unique_check("int_jobs_unioned", unified, "job_id"),
        RowChecks(unified, not_null_rules("int_jobs_unioned", ["job_id", "source"])),
        Check("locations_translated", quality.untranslated_locations(unified), WARN),
    ]


def star_checks(
    company: DataFrame, skill: DataFrame, fact: DataFrame, sources: Sequence[str]
) -> list:
    return [
        unique_check("dim_company", company, "company_id"),
        unique_check("dim_company", company, "company_name"),
        RowChecks(company, not_null_rules("dim_company", ["company_id", "company_name"])),
        unique_check("dim_skill", skill, "skill_id"),
        unique_check("dim_skill", skill, "skill_name"),
        RowChecks(skill, not_null_rules("dim_skill", ["skill_id", "skill_name"])),
        unique_check("fact_job_postings", fact, "job_id"),
        RowChecks(
            fact,
            [
                *not_null_rules("fact_job_postings", ["job_id", "source"]),
                accepted_rule("fact_job_postings", "source", sources),
                Rule("salary_range_valid", quality.salary_reversed()),
            ],
        ),
        relationship_check("fact_job_postings", fact, "company_id", company, "company_id"),
    ]


def bridge_checks(
    skill_pairs: DataFrame, region_pairs: DataFrame, fact: DataFrame, skill: DataFrame,
    params: Params,
) -> list:
    return [
        relationship_check("bridge_job_skill", skill_pairs, "job_id", fact, "job_id"),
        relationship_check("bridge_job_skill", skill_pairs, "skill_id", skill, "skill_id"),
        RowChecks(
            region_pairs,
            [
                *not_null_rules("bridge_job_region", ["job_id", "region"]),
                accepted_rule("bridge_job_region", "region", fixed.REGIONS),
            ],
        ),
        relationship_check("bridge_job_region", region_pairs, "job_id", fact, "job_id"),
        Check(
            "locations_have_region",
            quality.locations_without_region(region_pairs, fact, params.default_region),
            WARN,
        ),
    ]


def demand_checks(demand: DataFrame, by_region: DataFrame) -> list:
    counts = ["skill_id", "postings_count", "all_time_postings_count"]
    return [
        unique_check("mart_skill_demand", demand, "skill_id"),
        RowChecks(
            demand,
            [
                *not_null_rules("mart_skill_demand", counts),
                Rule("skill_demand_percentages_valid", quality.share_impossible()),
            ],
        ),
        unique_check("mart_postings_by_region", by_region, "region"),
        RowChecks(
            by_region, not_null_rules("mart_postings_by_region", ["region", "postings_count"])
        ),
    ]


def history_checks(daily: DataFrame, runs: DataFrame) -> list:
    return [
        RowChecks(daily, not_null_rules("fct_skill_demand_daily", ["snapshot_date", "skill_id"])),
        unique_check("mart_pipeline_runs", runs, "run_id"),
        RowChecks(
            runs,
            [
                *not_null_rules("mart_pipeline_runs", ["run_id"]),
                accepted_rule("mart_pipeline_runs", "status", fixed.RUN_STATUSES),
            ],
        ),
    ]


def build_models(
    warehouse: Warehouse,
    params: Params,
    sources: Sequence[SourceSpec] = SOURCES,
    seeds: Seeds | None = None,
) -> list:
    """Build all models; returns every check result. An error stops the layers below it.

    The unified postings are stored once and read by the dimension, the fact
    and the skill bridge, each of which reads only its columns of them.
    """
    seeds = seeds or default_seeds(warehouse.spark)
    results: list = []

    def gate(checks: list) -> None:
        results.extend(quality.enforce(quality.run_checks(checks)))

    raw = {s.name: raw_table(warehouse, s.name).read() for s in sources}
    staged = {s.name: s.stage(raw[s.name]) for s in sources}
    gate(
        seed_checks(seeds)
        + [c for name, df in raw.items() for c in raw_checks(name, df)]
        + [c for name, df in staged.items() for c in staging_checks(name, raw[name], df)]
    )

    parts = list(staged.values())
    unified = _publish(
        warehouse, "intermediate/int_jobs_unioned", unify(parts, seeds.translations)
    ).read()
    gate(unified_checks(unified))

    company = _publish(warehouse, "marts/dim_company", marts.dim_company(unified)).read()
    skill = _publish(warehouse, "marts/dim_skill", marts.dim_skill(seeds.skills)).read()
    fact = _publish(
        warehouse, "marts/fact_job_postings", marts.fact_postings(unified, params)
    ).read()
    gate(star_checks(company, skill, fact, list(raw)))

    skill_pairs = _publish(
        warehouse, "marts/bridge_job_skill",
        marts.bridge_job_skill(marts.with_activity_flag(unified, params), skill),
        schemas.BRIDGE_SKILL_STORED,
    ).read()
    region_pairs = _publish(
        warehouse, "marts/bridge_job_region",
        marts.bridge_job_region(fact, seeds.regions, params),
        schemas.BRIDGE_REGION_STORED,
    ).read()
    gate(bridge_checks(skill_pairs, region_pairs, fact, skill, params))

    demand = _publish(
        warehouse, "marts/mart_skill_demand", marts.skill_demand(skill, skill_pairs, fact)
    ).read()
    by_region = _publish(
        warehouse, "marts/mart_postings_by_region", marts.region_demand(region_pairs, fact)
    ).read()
    gate(demand_checks(demand, by_region))

    daily = warehouse.table(
        "marts/fct_skill_demand_daily", MODELS["marts/fct_skill_demand_daily"]
    )
    append_snapshot(daily, snapshot(demand, params.snapshot_date), params.snapshot_date)
    runs = _publish(
        warehouse, "marts/mart_pipeline_runs", pipeline_runs(load_runs(warehouse))
    ).read()
    gate(history_checks(daily.read(), runs))
    return results
