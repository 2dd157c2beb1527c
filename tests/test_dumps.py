import json
import os
import random

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from postlode.sources.dumps import read_array_dump, read_envelope_dump

NASTY = ['}', '{"a": [', '"}, {"', "\\", '\\"', "]}", '"jobs": [{', "é}ü{", "\n}\n", "", "a\\\\}"]


def records(n: int, seed: int = 0) -> list[dict]:
    rng = random.Random(seed)

    def value(depth: int):
        kind = rng.randrange(6 if depth else 4)
        if kind < 3:
            return "".join(rng.choice(NASTY) for _ in range(rng.randrange(4)))
        if kind == 3:
            return rng.choice([None, True, 0.0, 12, -1e9])
        items = [value(depth - 1) for _ in range(rng.randrange(3))]
        return items if kind == 4 else {rng.choice(NASTY) + str(i): x for i, x in enumerate(items)}

    return [{"id": i, **{f"k{j}": value(2) for j in range(rng.randrange(4))}} for i in range(n)]


@pytest.fixture(params=[250, 1 << 27])
def split_bytes(spark, request):
    """Splits of a size that cuts files inside strings, objects and keys."""
    settings = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 1}
    old = {k: spark.conf.get(k) for k in settings}
    for key, new in settings.items():
        spark.conf.set(key, str(new))
    yield request.param
    for key, value in old.items():
        spark.conf.set(key, value)


def put(folder: str, name: str, text: str) -> None:
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def in_order(df) -> list[str]:
    return [r.payload for r in df.orderBy("position").collect()]


@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_over_many_splits(spark, folder, split_bytes, indent):
    data = [records(40, 1), [], records(1, 2), [{"legal": "}"}, *records(25, 3)]]
    for i, rows in enumerate(data):
        put(folder, f"{i}.json", "  " + json.dumps(rows, indent=indent, ensure_ascii=i % 2 == 0) + "\n")
    found = in_order(read_array_dump(spark, folder))
    assert [json.loads(x) for x in found] == [r for rows in data for r in rows]
    if indent is None:
        assert found == [json.dumps(r, ensure_ascii=i % 2 == 0) for i, rows in enumerate(data) for r in rows]


def test_envelopes_over_many_splits(spark, folder, split_bytes):
    other = records(9, 8)
    files = [
        {"notice": '"jobs": [{}', "n": 3, "jobs": records(30, 4)},
        {"meta": {"jobs": other, "x": {"jobs": [{"no": 1}]}}, "list": other, "jobs": records(12, 5), "more": other, "end": {"a": {"b": {}}}},
        {"notice": "the field is missing", "job": other},
        {"jobs": []}, {"jobs": None}, {}, {"jobs": [{}]},
    ]
    for i, envelope in enumerate(files):
        put(folder, f"{i}.json", json.dumps(envelope, indent=i % 2 or None, ensure_ascii=False))
    found = [json.loads(x) for x in in_order(read_envelope_dump(spark, folder))]
    assert found == [r for e in files for r in e.get("jobs") or []]
    assert [json.loads(x) for x in in_order(read_envelope_dump(spark, folder, "list"))] == other


def test_one_posting_over_many_splits(spark, folder, split_bytes):
    rows = [{"id": 1}, {"id": 2, "text": "a}b\"{" * 2000}, {"id": 3}]
    put(folder, "a.json", json.dumps(rows))
    assert [json.loads(x) for x in in_order(read_array_dump(spark, folder))] == rows


@pytest.mark.parametrize(
    "text", ['[{"a": 1}', '{"a": 1}', "<html>", '[{"a": "x}]', '[{"a": 1}, 7, {"b": 2}]', '[{"a": 1}]]', '[["x", {"a": 1}]', "7"]
)
def test_what_is_no_array_of_objects_fails(spark, folder, text):
    put(folder, "a.json", text)
    with pytest.raises((PySparkException, Py4JError), match="malformed"):
        read_array_dump(spark, folder).collect()


@pytest.mark.parametrize("text", ['{"jobs": [{"a": 1}]', '[{"a": 1}]', '{"jobs": [{"a": 1}], "x": "}'])
def test_what_is_no_object_fails(spark, folder, text):
    put(folder, "a.json", text)
    with pytest.raises((PySparkException, Py4JError), match="malformed"):
        read_envelope_dump(spark, folder).collect()


def test_empty_file_has_no_postings(spark, folder):
    put(folder, "a.json", "")
    assert read_array_dump(spark, folder).count() == 0
