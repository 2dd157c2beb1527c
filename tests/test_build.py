from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from postlode import fixed_values as fixed
from postlode import schemas
from postlode.operators import marts, reports
from postlode.operators.quality import QualityError
from postlode.operators.unify import in_scope, unify
from postlode.params import Params
from postlode.plans.build import (
    MODELS,
    Seeds,
    build_models,
    default_seeds,
    model,
    models_exist,
    register_views,
)
from postlode.plans.daily import run_daily
from postlode.sources.seeds import seed_table
from postlode.sources.tables import Warehouse
from samples import A1, A3, B1, B2, DAY, DUMP_A, DUMP_B, T0, damage, dump, land


@pytest.fixture(scope="module")
def built(spark):
    """The sample dumps landed and built once, shared by the tests that only read."""
    import tempfile

    warehouse = land(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    assert not models_exist(warehouse)
    results = build_models(warehouse, Params(T0))
    return warehouse, results


def test_all_checks_run_and_pass(built):
    _, results = built
    assert len(results) == 66
    assert len({r["check"] for r in results}) == 66
    assert {r["status"] for r in results} == {"pass"}
    assert sum(r["severity"] == "warn" for r in results) == 3


def test_fact_and_dimensions(built):
    warehouse, _ = built
    assert models_exist(warehouse)
    fact = {r.job_id: r for r in model(warehouse, "fact_job_postings").collect()}
    assert len(fact) == 5 and all(r.is_active and r.is_remote for r in fact.values())
    lead = fact["remoteok_tern-1"]
    assert (lead.salary_min, lead.salary_max) == (None, Decimal("61000.25"))
    assert fact["remoteok_tern-3"].salary_min == Decimal(52000)
    assert lead.posted_at.isoformat() == "2026-08-17T20:53:20"
    assert fact["remotive_8101"].posted_at.isoformat() == "2026-08-18T03:04:05"
    companies = {r.company_name: r.company_id for r in model(warehouse, "dim_company").collect()}
    assert sorted(companies) == ["Ochre Works", "Tern & Tide", "Umber"]
    assert fact["remotive_8104"].company_id == companies["Tern & Tide"] == fact["remoteok_tern-3"].company_id
    assert model(warehouse, "dim_skill").count() == 35


def test_bridges(built):
    warehouse, _ = built
    skills = model(warehouse, "bridge_job_skill")
    assert skills.columns == ["job_id", "skill_id"]
    per_posting = {r.job_id: r["count"] for r in skills.groupBy("job_id").count().collect()}
    assert per_posting == {
        "remoteok_tern-1": 5, "remoteok_tern-3": 3, "remotive_8101": 3, "remotive_8102": 3,
    }
    regions = model(warehouse, "bridge_job_region")
    assert regions.columns == ["job_id", "region"] and regions.count() == 7


def test_skill_demand(built):
    warehouse, _ = built
    demand = {r.skill_name: r for r in model(warehouse, "mart_skill_demand").collect()}
    counts = {n: r.postings_count for n, r in demand.items() if r.postings_count}
    assert len(demand) == 35
    ones = ["Apache Spark", "Apache Kafka", "GCP", "Scala", "MySQL", "Docker", "Java", "BigQuery", "Looker", "dbt", "Git", "CI/CD"]
    assert counts == {"Terraform": 2, **dict.fromkeys(ones, 1)}
    assert demand["Terraform"].pct_of_active_postings == Decimal("40.00")
    assert demand["Java"].pct_of_all_postings == Decimal("20.00")
    assert demand["Python"].pct_of_active_postings == Decimal("0.00")


def test_region_demand(built):
    warehouse, _ = built
    rows = model(warehouse, "mart_postings_by_region").collect()
    assert {r.region: (r.postings_count, r.pct_of_active_postings) for r in rows} == {
        "Europe": (2, Decimal("40.0")), "North America": (1, Decimal("20.0")),
        "Latin America": (1, Decimal("20.0")), "Middle East": (1, Decimal("20.0")),
        "Worldwide": (1, Decimal("20.0")), "Unspecified": (1, Decimal("20.0")),
    }


def test_models_have_their_contract_and_views(built, spark):
    warehouse, _ = built
    for name, schema in MODELS.items():
        assert model(warehouse, name).columns == schema.names
    register_views(warehouse)
    assert spark.sql("select count(*) n from fact_job_postings where is_active").first().n == 5


def test_joins_left_out_of_the_build_give_the_same(built):
    """The company key equals the join to the dimension; carried activity equals the join to the fact."""
    warehouse, _ = built
    unified = model(warehouse, "int_jobs_unioned")
    joined = marts.attach_dimension(unified, marts.dim_company(unified), "company_name")
    fact = model(warehouse, "fact_job_postings")
    assert sorted(map(tuple, joined.select("job_id", "company_id").collect())) == sorted(
        map(tuple, fact.select("job_id", "company_id").collect())
    )
    pairs = marts.with_activity(model(warehouse, "bridge_job_skill"), fact)
    demand = marts.skill_demand(model(warehouse, "dim_skill"), pairs.unionByName(pairs).distinct(), fact)
    assert sorted(map(tuple, demand.collect())) == sorted(
        map(tuple, model(warehouse, "mart_skill_demand").collect())
    )


def test_dashboard(built):
    warehouse, _ = built
    fact, demand = model(warehouse, "fact_job_postings"), model(warehouse, "mart_skill_demand")
    status = reports.latest_run_status(model(warehouse, "mart_pipeline_runs"))
    assert tuple(reports.headline(fact, demand, status).first()) == (5, 5, 3, 35, "SUCCESS")
    none = reports.latest_run_status(model(warehouse, "mart_pipeline_runs").where("false"))
    assert reports.headline(fact, demand, none).first().last_run == "n/a"
    assert reports.top_skills(demand, 2).first().skill_name == "Terraform"
    listing = reports.active_listing(fact, model(warehouse, "dim_company")).collect()
    assert {r.company_name for r in listing} == {"Ochre Works", "Tern & Tide", "Umber"}


def test_activity_ages_out_and_history_stays(spark, folder):
    warehouse = land(spark, folder)
    build_models(warehouse, Params(T0))
    edge = Params(T0 + 14 * DAY)
    build_models(warehouse, edge)
    assert model(warehouse, "fact_job_postings").where("is_active").count() == 5  # inclusive
    past = Params(T0 + 14 * DAY + timedelta(seconds=1))
    build_models(warehouse, past)
    assert model(warehouse, "fact_job_postings").where("is_active").count() == 0
    terraform = model(warehouse, "mart_skill_demand").where("skill_name = 'Terraform'").first()
    assert (terraform.postings_count, terraform.pct_of_active_postings) == (0, None)
    assert (terraform.all_time_postings_count, terraform.pct_of_all_postings) == (2, Decimal("40.00"))
    assert model(warehouse, "mart_postings_by_region").count() == 0
    daily = model(warehouse, "fct_skill_demand_daily")
    days = {str(r.snapshot_date): r["count"] for r in daily.groupBy("snapshot_date").count().collect()}
    assert days == {"2026-08-20": 35, "2026-09-03": 35}


def test_same_day_rerun_replaces_by_key(spark, folder):
    warehouse = land(spark, folder)
    build_models(warehouse, Params(T0))
    seeds = default_seeds(spark)
    fewer = Seeds(seeds.skills.where("skill_name <> 'Terraform'"), seeds.regions, seeds.translations)
    build_models(warehouse, Params(T0 + timedelta(hours=3)), seeds=fewer)
    daily = model(warehouse, "fct_skill_demand_daily")
    assert daily.count() == 35  # the dropped skill keeps its earlier row
    assert daily.where("skill_name = 'Terraform'").first().postings_count == 2
    assert model(warehouse, "mart_skill_demand").count() == 34


def test_an_error_stops_the_layers_below(spark, folder):
    bad = {**A1, "salary_min": 5, "salary_max": 1}
    warehouse = land(spark, folder, a=[bad, A3])
    with pytest.raises(QualityError, match="salary_range_valid: 1"):
        build_models(warehouse, Params(T0))
    assert warehouse.table("marts/fact_job_postings", schemas.FACT).exists()
    assert not warehouse.table("marts/bridge_job_skill", schemas.BRIDGE_SKILL).exists()


def test_names_that_differ_by_case_fail_the_company_check(spark, folder):
    warehouse = land(spark, folder, b={"jobs": [B1, {**B2, "company_name": "tern & tide"}]})
    with pytest.raises(QualityError, match="unique_dim_company_company_id"):
        build_models(warehouse, Params(T0))


def test_warnings_do_not_stop_the_build(spark, folder):
    cut = damage("東京")[:5]
    warehouse = land(
        spark, folder,
        a=[{**A1, "location": cut}, {**A3, "location": "東京, "}, {**A3, "id": "7", "location": "Atlantis"},
           {**A3, "id": "8", "location": "REMOTO"}],
    )
    results = {r["check"]: r for r in build_models(warehouse, Params(T0))}
    warned = {n: r["failures"] for n, r in results.items() if r["status"] == "warn"}
    assert warned == {"no_mojibake_in_text": 1, "locations_translated": 1, "locations_have_region": 1}
    fact = {r.job_id: r.location for r in model(warehouse, "fact_job_postings").collect()}
    assert fact["remoteok_tern-1"] is None and fact["remoteok_tern-3"] is None


def test_bad_salary_text_fails(spark, folder):
    warehouse = land(spark, folder, a=[{**A1, "salary_min": ""}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_models(warehouse, Params(T0))


def test_daily_run(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    dumps = {"remoteok": dump(folder, "a", DUMP_A), "remotive": f"{folder}/nowhere"}
    params = Params(T0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_daily(warehouse, dumps, params)
    assert not models_exist(warehouse)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_daily(warehouse, dumps, params, keep_going=True)
    assert model(warehouse, "fact_job_postings").count() == 2
    dumps["remotive"] = dump(folder, "b", DUMP_B)
    assert len(run_daily(warehouse, dumps, params)) == 66
    status = reports.latest_run_status(model(warehouse, "mart_pipeline_runs")).first()
    assert status.overall == "SUCCESS"
    assert model(warehouse, "mart_pipeline_runs").where("status = 'failed'").count() == 2


STAGED_ROW = dict(
    job_id="1", source="s", title=" Data role ", company_name="  A  B ", location="Curitiba, ",
    is_remote=None, tags=None, description=None, posting_url=None, salary_min=None, salary_max=None,
    posted_at=None, source_category=None, first_seen_at=None, last_seen_at=None,
)


def unified_row(spark, **values):
    staged = spark.createDataFrame([{**STAGED_ROW, **values}], schemas.STAGED)
    seed = seed_table(spark, fixed.LOCATION_TRANSLATIONS, schemas.TRANSLATION_SEED)
    return unify([staged], seed).first()


@pytest.mark.parametrize(
    "location, source_location, shown",
    [
        ("Curitiba, ", "Curitiba", "Curitiba"),
        (",  ,", None, None),
        (None, None, None),
        ("مسقط , ", "مسقط", "Muscat, Oman"),
        ("北京", "北京", None),
        ("São  Paulo", "São Paulo", "São Paulo"),
        (damage("é") + ", ", None, None),
    ],
)
def test_location_cleanup(spark, location, source_location, shown):
    row = unified_row(spark, location=location)
    assert (row.source_location, row.location) == (source_location, shown)


def test_text_cleanup_of_a_unified_row(spark):
    row = unified_row(spark)
    assert (row.title, row.company_name, row.is_remote) == ("Data role", "A B", False)
    assert unified_row(spark, company_name=damage("é")).company_name is None
    assert unified_row(spark, title="Data " + damage("é")).title == "Data " + damage("é")


@pytest.mark.parametrize(
    "category, title, kept",
    [
        ("Software Development", "Chef", True), ("Marketing", "Head of Database", True),
        ("Marketing", "Chef", False), (None, "DEVOPS lead", True), (None, "Civil Engineer", False),
        ("Software Development", None, False), (None, None, False),
    ],
)
def test_scope(one, category, title, kept):
    got = one(in_scope(F.col("c"), F.col("t")), "c string, t string", category, title)
    assert bool(got) is kept
