import pytest
from pyspark.sql import functions as F

from postlode.functions.variant import first_value, with_variant


def read(spark, payloads, *columns):
    return [tuple(r) for r in with_variant(spark.createDataFrame([(p,) for p in payloads], "payload string")).select(*columns).collect()]


def test_first_value_passes_over_what_is_not_of_its_kind(spark):
    paths = ["$.a", "$.a.b", "$.c[0]"]
    rows = read(
        spark,
        ['{"a": "x", "c": ["z"]}', '{"a": {"b": "y"}}', '{"a": [1], "c": ["z"]}', '{"a": null, "c": ["z"]}', '{"a": 1.5}',
         '{"a": ""}', "{}", "[]", "null", None],
        first_value(paths),
    )
    assert [r[0] for r in rows] == ["x", "y", "z", "z", "1.5", "", None, None, None, None]


def test_numbers_of_any_form(spark):
    kind = "decimal(38,10)"
    payloads = ['{"n": 5}', '{"n": "7.25"}', '{"n": "much", "m": {"n": 1e2}}', '{"n": true}', '{"n": {"n": 3}}']
    rows = read(spark, payloads, first_value(["$.n", "$.m.n"], kind).cast("double"))
    assert [r[0] for r in rows] == [5.0, 7.25, 100.0, 1.0, None]


def test_bad_json_fails_and_a_payload_is_parsed_once(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read(spark, ["{"], "v")
    rows = with_variant(spark.createDataFrame([("{}",)], "payload string")).select(
        first_value(["$.a", "$.b"]).alias("x"), first_value(["$.c"], "long").alias("y")
    ).where((F.col("x") == "1") | (F.col("y") > 2))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1
