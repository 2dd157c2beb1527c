from datetime import datetime, timedelta, timezone

import pytest

from postlode.operators import quality
from postlode.operators.quality import WARN, Check, QualityError, RowChecks, not_null_rules
from postlode.params import Params
from test_text import damage


def frame(spark, values, schema="v string"):
    return spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_unique(spark):
    assert rows(quality.duplicates(frame(spark, ["a", "b", None, None]), "v")) == []
    assert rows(quality.duplicates(frame(spark, ["a", "b", "a", None]), "v")) == [("a", 2)]


def test_not_null(spark):
    df = frame(spark, [("a", None), ("b", "x")], "v string, w string")
    assert rows(quality.nulls(df, "v")) == []
    assert quality.nulls(df, "w").count() == 1
    got = {r.check: r.failures for r in RowChecks(df, not_null_rules("t", ["v", "w"])).summary().collect()}
    assert got == {"not_null_t_v": 0, "not_null_t_w": 1}


def test_accepted(spark):
    df = frame(spark, ["a", None, "z", "z"])
    assert rows(quality.unaccepted(df, "v", ["a", "z"])) == []
    assert rows(quality.unaccepted(df, "v", ["a"])) == [("z", 2)]


def test_relationships(spark):
    child, parent = frame(spark, ["a", None, "x", "x"]), frame(spark, ["a", None])
    assert rows(quality.orphans(child, "v", parent, "v")) == [("x", 2)]
    check = quality.relationship_check("t", child, "v", parent, "v")
    assert check.summary().first().failures == 2  # child rows
    assert quality.relationship_check("t", parent, "v", child, "v").summary().first().failures == 0


def test_salary_range(spark):
    df = frame(
        spark, [("1", 5, 4), ("2", 4, 4), ("3", None, 4), ("4", 5, None)],
        "job_id string, salary_min int, salary_max int",
    )
    assert rows(quality.salary_out_of_order(df)) == [("1", 5, 4)]


def test_share_range(spark):
    df = frame(
        spark, [("a", 0.0), ("b", 100.0), ("c", 100.01), ("d", -0.1), ("e", None)],
        "skill_id string, pct_of_active_postings double",
    )
    assert [r[0] for r in rows(quality.share_out_of_range(df))] == ["c", "d"]


def test_mojibake(spark):
    schema = "job_id string, title string, company_name string, location string"
    bad = damage("é")
    a = frame(spark, [("1", bad, None, None), ("2", "x", "é", None)], schema)
    b = frame(spark, [("3", "x", None, bad), ("4", None, bad, None), ("5", None, None, None)], schema)
    assert [r[0] for r in rows(quality.residual_mojibake([a, b]))] == ["1", "3", "4"]


def test_locations(spark):
    unified = frame(
        spark, [("東京", None), ("東京", None), ("مسقط", "Muscat"), ("Rome", "Rome"), (None, None)],
        "source_location string, location string",
    )
    assert rows(quality.untranslated_locations(unified)) == [("東京",)]
    fact = frame(
        spark, [("1", "Atlantis"), ("2", "Remote"), ("3", "REMOTO"), ("4", None), ("5", "Rome"),
                ("6", "Remotely")],
        "job_id string, location string",
    )
    regions = frame(
        spark, [(str(i), "Unspecified") for i in (1, 2, 3, 4, 6)] + [("5", "Europe")],
        "job_id string, region string",
    )
    assert rows(quality.locations_without_region(regions, fact)) == [("Atlantis",), ("Remotely",)]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (30, "pass"), (30.1, "warn"), (72, "warn"), (72.1, "error"), (None, "error")]
)
def test_freshness(spark, hours, status):
    as_of = datetime(2026, 8, 20, tzinfo=timezone.utc)
    seen = [] if hours is None else [(as_of - timedelta(hours=hours),)]
    raw = spark.createDataFrame(seen, "last_seen_at timestamp")
    assert quality.freshness("s", raw, Params(as_of)).first().status == status


def test_warnings_report_and_errors_stop(spark):
    failing, passing = frame(spark, ["x"]), frame(spark, [])
    results = quality.run_checks([Check("w", failing, WARN), Check("e", passing)])
    assert [(r["check"], r["failures"], r["status"]) for r in quality.enforce(results)] == [
        ("e", 0, "pass"), ("w", 1, "warn"),
    ]
    with pytest.raises(QualityError, match="e: 1"):
        quality.enforce(quality.run_checks([Check("e", failing)]))
