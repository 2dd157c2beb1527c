import json

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from postlode import schemas
from postlode.functions.text import contains_any
from postlode.operators import landing
from postlode.plans.ingest import SOURCE_A, SOURCE_B, keyed_batch
from test_text import damage


@pytest.mark.parametrize(
    "title, description, tags, relevant",
    [
        ("Beekeeper", "honey", ["python"], True),
        ("Software Tinkerer", "", [], True),
        ("Beekeeper", "moves hives by an ETL script", [], True),
        ("Beekeeper", "honey and wax", ["hives"], False),
        ("SOFTWARE TINKERER", "", None, True),
        ("shelter keeper", None, None, True),  # substring, no word boundary: "elt"
        ("machine", "x", ["learning"], True),  # the match runs across title and tags
        ("machine", None, None, False),
        (None, None, None, False),
        ("html", "", [], True),  # "ml " ends at the joining space
        ("x", "html", [], False),
    ],
)
def test_relevance(one, title, description, tags, relevant):
    rule = landing.is_relevant("t", "d", "g")
    assert one(rule, "t string, d string, g array<string>", title, description, tags) is relevant


def test_contains_any_of_null_is_null(one):
    assert one(contains_any("s", ["a", "b"]), "s string", None) is None


def batch(spark, spec, *records):
    rows = [(json.dumps(r), i) for i, r in enumerate(records)]
    return keyed_batch(spec, spark.createDataFrame(rows, "payload string, position int"))


DATA = {"position": "Data person"}


@pytest.mark.parametrize(
    "ids, key",
    [
        ({"id": "12", "slug": "s"}, "remoteok_12"),
        ({"id": 12}, "remoteok_12"),
        ({"slug": "s"}, "remoteok_s"),
        ({"id": "", "slug": "s"}, "remoteok_s"),
        ({"id": None, "slug": "s"}, "remoteok_s"),
        ({"id": 0, "slug": "s"}, "remoteok_s"),
        ({"id": False, "slug": "s"}, "remoteok_s"),
        ({"id": "0", "slug": "s"}, "remoteok_0"),
    ],
)
def test_key_of_source_a(spark, ids, key):
    assert [r.job_id for r in batch(spark, SOURCE_A, {**DATA, **ids}).collect()] == [key]


@pytest.mark.parametrize("ids", [{"id": None}, {"id": "", "slug": None}, {"slug": 0}])
def test_a_present_but_empty_key_fails_the_run(spark, ids):
    with pytest.raises(PySparkException, match="neither 'id' nor 'slug'"):
        batch(spark, SOURCE_A, {**DATA, **ids}).collect()


def test_notice_and_irrelevant_records_are_dropped(spark):
    kept = batch(
        spark, SOURCE_A,
        {"terms": "see the licence page", "generated": 20260101},
        {"id": "k-1", "position": "Pastry Chef", "tags": ["oven"], "description": "croissants, early shifts"},
        {"id": "k-2", "position": "Lighthouse Keeper", "tags": ["software"], "description": None},
    )
    assert [r.job_id for r in kept.collect()] == ["remoteok_k-2"]


def test_category_beats_words_in_source_b(spark):
    kept = batch(
        spark, SOURCE_B,
        {"id": 31, "category": "Legal", "description": "python sql etl, all of the words"},
        {"id": 32, "category": "Software Development", "description": "no word of it"},
        {"id": 33, "description": "python"},
    )
    assert [r.job_id for r in kept.collect()] == ["remotive_32"]


def test_missing_id_in_source_b_fails(spark):
    with pytest.raises(PySparkException, match="no 'id'"):
        batch(spark, SOURCE_B, {"category": "Software Development"}).collect()


def test_bad_json_fails(spark):
    df = spark.createDataFrame([("{not json", 0)], "payload string, position int")
    with pytest.raises((PySparkException, Py4JError), match="(?i)malformed"):
        keyed_batch(SOURCE_A, df).collect()


def test_payload_repair_reaches_any_depth_and_keeps_the_rest(spark):
    def record(text):
        return {
            **DATA, "id": "k-9", "location": text("Łódź"), "tags": [text("naïve"), "plain"],
            "levels": [[{"x": [text("señal")]}], {damage("größe"): 4}], damage("größe"): text("ß"),
            "epoch": 1700000001, "remote": None, "ratio": 2.25, "lone": "\udc00", "path": "C:\\", "q": 'a "b": ' + text("ø"),
        }

    (row,) = batch(spark, SOURCE_A, record(damage)).collect()
    assert json.loads(row.payload) == record(str)


@pytest.mark.parametrize("escaped", [True, False])
def test_escaped_and_plain_damage_are_repaired_alike(spark, escaped):
    damaged = {**DATA, "id": "k-3", "note": damage("Übung") + " \\u00e9 \n"}
    df = spark.createDataFrame([(json.dumps(damaged, ensure_ascii=escaped), 0)], "payload string, position int")
    got = json.loads(keyed_batch(SOURCE_A, df).first().payload)
    assert got == {**DATA, "id": "k-3", "note": "Übung \\u00e9 \n"}


def test_only_plain_fields_are_unescaped(spark):
    record = {
        "id": "k-4", "position": "Software &quot;Q&amp;A&quot;", "company": damage("Café") + " &ouml;",
        "location": "X&amp;lt;Y", "description": "<i>Salt &amp; Pepper</i>", "more": {"position": "a &amp; b"}, "n": 2.5,
    }
    (row,) = batch(spark, SOURCE_A, record).collect()
    assert json.loads(row.payload) == {
        **record, "position": 'Software "Q&A"', "company": "Café ö", "location": "X&lt;Y",
    }


def test_landing_runs_no_python(spark):
    df = spark.createDataFrame([("{}", 0)], "payload string, position int")
    plan = keyed_batch(SOURCE_A, df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_untouched_payloads_keep_their_text(spark):
    text = '{"id":"1",  "position": "Data", "n": 1.0}'
    df = spark.createDataFrame([(text, 0)], "payload string, position int")
    assert keyed_batch(SOURCE_A, df).first().payload == text


def test_payload_is_parsed_once_per_row(spark):
    df = spark.createDataFrame([("{}", 0)], "payload string, position int")
    kept = landing.with_payload(df, schemas.SOURCE_B_LANDING).where(landing.keep_source_b())
    plan = kept.select("p.id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


ODD_JSON = (
    '{ "id" : "k-7",\t"salary_min":0.0, "a":1e2, "b":-0.0,"c":12345678901234567890123456789012345678901234567890,'
    ' "position":"Data &amp; More \\/ \\u00e9", "s":"lone \\ud800 \\/ \\u00e9 &amp;", "a":1.50, "position":"SQL &lt;x&gt;",'
    '"LONG":{"company":"T &amp; C","x":["Ã¼", "Ã¼\\"\\u00c3\\u00bc:", ":"]},"co\\u006dpany":"Tern &amp; Ã¼","e":{},"f":[]}'
)


def test_only_the_strings_that_change_are_rewritten(spark):
    long = "Ã¼" * 2500
    text = ODD_JSON.replace("LONG", long)
    df = spark.createDataFrame([(text, 0)], "payload string, position int")
    got = keyed_batch(SOURCE_A, df).first().payload
    expected = text.replace("Data &amp; More \\/ \\u00e9", "Data & More / é").replace("&lt;x&gt;", "<x>")
    expected = expected.replace('"Ã¼",', '"ü",').replace('Ã¼\\"\\u00c3\\u00bc:', 'ü\\"ü:').replace("Tern &amp; Ã¼", "Tern & ü")
    assert got == expected and long in got


def test_another_field_does_not_change_a_number(spark):
    rows = [(f'{{"id":"{i}","position":"Data","company":"{c}","salary_min":0.0,"tags":[]}}', i) for i, c in ((1, "Tern &amp; Co"), (2, "Tern Co"))]
    df = spark.createDataFrame(rows, "payload string, position int")
    for row in keyed_batch(SOURCE_A, df).collect():
        assert '"salary_min":0.0,' in row.payload


def test_thousands_of_escapes_need_no_stack(spark):
    text = json.dumps({"id": "1", "position": "Data " + damage("ü"), "description": 'a\n"b" \\ ' * 20_000 + damage("é")}, ensure_ascii=False)
    df = spark.createDataFrame([(text, 0)], "payload string, position int")
    assert json.loads(keyed_batch(SOURCE_A, df).first().payload)["description"].endswith("\\ é")
