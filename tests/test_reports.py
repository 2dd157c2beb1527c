from datetime import date, datetime, timedelta

import pytest

from postlode.operators import reports

NOW = datetime(2026, 8, 20, 6)


def runs(spark, *rows):
    return spark.createDataFrame(
        [(str(i), source, NOW - timedelta(hours=ago), status) for i, (source, ago, status) in enumerate(rows)],
        "run_id string, source string, started_at timestamp, status string",
    )


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("a", 0, "success"), ("b", 1, "success")], ("SUCCESS", "a: success, b: success")),
        ([("a", 0, "success"), ("b", 1, "failed")], ("FAILED", "a: success, b: failed")),
        ([("a", 0, "success"), ("a", 5, "failed")], ("SUCCESS", "a: success")),
        ([("a", 0, "failed"), ("a", 5, "success")], ("FAILED", "a: failed")),
        ([("a", 0, "success"), ("b", 24, "failed")], ("FAILED", "a: success, b: failed")),
        ([("a", 0, "success"), ("b", 24.1, "failed")], ("SUCCESS", "a: success")),
    ],
)
def test_latest_status(spark, rows, expected):
    assert tuple(reports.latest_run_status(runs(spark, *rows)).first()) == expected


def test_no_runs(spark):
    assert reports.latest_run_status(runs(spark).where("false")).count() == 0


def demand(spark):
    return spark.createDataFrame(
        [("1", "Beta", "bi", 5), ("2", "Alpha", "ml", 5), ("3", "Gamma", "cloud", 9), ("4", "None", "bi", 0)],
        "skill_id string, skill_name string, category string, all_time_postings_count long",
    )


def test_ranking(spark):
    def names(df):
        return [r.skill_name for r in df.collect()]

    assert names(reports.top_skills(demand(spark))) == ["Gamma", "Alpha", "Beta"]
    assert names(reports.top_skills(demand(spark), 2)) == ["Gamma", "Alpha"]
    assert names(reports.top_skills(demand(spark), 5, "BI")) == ["Beta"]
    assert [r[0] for r in reports.categories(demand(spark)).collect()] == ["BI", "Cloud", "ML"]


def test_regions_pin_the_unspecified(spark):
    df = spark.createDataFrame(
        [("Europe", 7), ("Unspecified", 9), ("Africa", 1)], "region string, postings_count long"
    )
    got = [r.region for r in reports.region_ranking(df).collect()]
    assert got == ["Unspecified", "Africa", "Europe"]


def test_trend_needs_two_days(spark):
    def daily(*days):
        return spark.createDataFrame(
            [(d, n, 1) for d in days for n in ("Alpha", "Beta", "Gamma")],
            "snapshot_date date, skill_name string, postings_count int",
        )

    one, two = date(2026, 8, 19), date(2026, 8, 20)
    assert reports.trend(daily(one), demand(spark), 2).count() == 0
    got = [(r.snapshot_date, r.skill_name) for r in reports.trend(daily(two, one), demand(spark), 2).collect()]
    assert got == [(one, "Alpha"), (one, "Gamma"), (two, "Alpha"), (two, "Gamma")]


def test_listing_fills_gaps_and_fans_out_like_a_join(spark):
    fact = spark.createDataFrame(
        [("1", "c", "T1", None, None, True), ("2", None, "T2", "Rome", "u", True), ("3", "c", "T3", "x", "y", False)],
        "job_id string, company_id string, title string, location string, posting_url string, is_active boolean",
    )
    companies = spark.createDataFrame([("c", "Acme"), ("c", "ACME")], "company_id string, company_name string")
    got = sorted(map(tuple, reports.active_listing(fact, companies).collect()))
    assert got == [
        ("T1", "ACME", "Unspecified", ""), ("T1", "Acme", "Unspecified", ""), ("T2", "Unspecified", "Rome", "u"),
    ]
