import json
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from postlode import schemas
from postlode.operators import runlog
from postlode.plans import ingest
from postlode.plans.ingest import SOURCE_A, SOURCE_B, raw_table, run_source
from postlode.sources import read_array_dump, read_envelope_dump, read_json_lines, read_seed
from postlode.sources.tables import Warehouse
from samples import A1, A3, DAY, DUMP_A, DUMP_B, T0, at, dump, land


def raw(warehouse, source="remoteok"):
    rows = raw_table(warehouse, source).read().collect()
    return {r.job_id: (json.loads(r.payload), r.first_seen_at, r.last_seen_at) for r in rows}


def files(warehouse, source="remoteok"):
    """Files of each day of a raw table."""
    found = {}
    for f in raw_table(warehouse, source).read().inputFiles():
        found.setdefault(re.search("part=([^/]*)/", f).group(1), set()).add(f)
    return found


def naive(t):
    return t.replace(tzinfo=None)


def last_run(warehouse):
    return runlog.load_runs(warehouse).orderBy(F.desc("started_at")).first()


def test_dump_readers(spark, folder):
    a = read_array_dump(spark, dump(folder, "a", DUMP_A))
    assert [json.loads(r.payload) for r in a.orderBy("position").collect()] == DUMP_A
    b = read_envelope_dump(spark, dump(folder, "b", DUMP_B))
    assert b.count() == 4
    assert read_envelope_dump(spark, dump(folder, "none", {"count": 0})).count() == 0
    assert read_array_dump(spark, dump(folder, "empty", [])).count() == 0


def test_json_lines_keep_their_order_in_a_split_file(spark, folder):
    with open(f"{folder}/x.jsonl", "w", encoding="utf-8") as f:
        f.writelines(json.dumps({"id": i, "pad": "x" * 200}) + "\n\n" for i in range(2000))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        lines = read_json_lines(spark, f"{folder}/x.jsonl")
        assert lines.rdd.getNumPartitions() > 4
        ids = [json.loads(r.payload)["id"] for r in lines.orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert ids == list(range(2000))


def test_seed_csv(spark, folder):
    with open(f"{folder}/t.csv", "w", encoding="utf-8") as f:
        f.write('source_location,location_en\n"دبي, دبي","Dubai, UAE"\nمسقط,"The ""Muscat"""\n')
    seed = read_seed(spark, f"{folder}/t.csv", schemas.TRANSLATION_SEED)
    assert [tuple(r) for r in seed.collect()] == [("دبي, دبي", "Dubai, UAE"), ("مسقط", 'The "Muscat"')]


def test_a_run_lands_what_is_relevant_and_logs_what_it_read(spark, folder):
    warehouse = land(spark, folder)
    assert sorted(raw(warehouse)) == ["remoteok_tern-1", "remoteok_tern-3"]
    assert sorted(raw(warehouse, "remotive")) == ["remotive_8101", "remotive_8102", "remotive_8104"]
    assert raw(warehouse)["remoteok_tern-3"][0]["company"] == "Tern & Tide"
    assert raw(warehouse)["remoteok_tern-1"][0] == A1
    runs = {r.source: r for r in runlog.load_runs(warehouse).collect()}
    assert (runs["remoteok"].records_fetched, runs["remoteok"].records_upserted) == (4, 2)
    assert (runs["remotive"].records_fetched, runs["remotive"].records_upserted) == (4, 3)
    assert {r.status for r in runs.values()} == {"success"}
    assert len({r.run_id for r in runs.values()}) == 2


def test_upsert_updates_keeps_and_inserts(spark, folder):
    warehouse = land(spark, folder)
    changed = {**A1, "description": "changed data"}
    new = {**A3, "id": "tern-4"}
    path = dump(folder, "a-next", [changed, new])
    assert run_source(warehouse, SOURCE_A, path, clock=at(T0 + DAY)) == 2
    got = raw(warehouse)
    t0, t1 = naive(T0), naive(T0 + DAY)
    assert got["remoteok_tern-1"] == (changed, t0, t1)
    assert got["remoteok_tern-3"][1:] == (t0, t0)
    assert got["remoteok_tern-4"][1:] == (t1, t1)
    assert sorted(files(warehouse)) == ["2026-08-20", "2026-08-21"]


def test_rerun_changes_only_last_seen(spark, folder):
    warehouse = land(spark, folder)
    before = raw(warehouse)
    for later in (T0 + timedelta(hours=1), T0 + 2 * DAY):
        run_source(warehouse, SOURCE_A, dump(folder, "a0", DUMP_A), clock=at(later))
        after = raw(warehouse)
        assert {k: v[:2] for k, v in after.items()} == {k: v[:2] for k, v in before.items()}
        assert {v[2] for v in after.values()} == {naive(later)}
    assert sorted(files(warehouse)) == ["2026-08-20"]


def test_days_without_a_batch_key_are_not_rewritten(spark, folder):
    warehouse = land(spark, folder)
    old = files(warehouse)
    run_source(warehouse, SOURCE_A, dump(folder, "n", [{**A3, "id": "9"}]), clock=at(T0 + DAY))
    now = files(warehouse)
    assert now["2026-08-20"] == old["2026-08-20"] and "2026-08-21" in now


def test_new_keys_join_those_of_an_earlier_run_of_the_day(spark, folder):
    warehouse = land(spark, folder)
    later = T0 + timedelta(hours=1)
    run_source(warehouse, SOURCE_A, dump(folder, "n", [{**A3, "id": "9"}]), clock=at(later))
    got = raw(warehouse)
    assert sorted(got) == ["remoteok_9", "remoteok_tern-1", "remoteok_tern-3"]
    assert got["remoteok_tern-1"][1:] == (naive(T0), naive(T0)) and got["remoteok_9"][1] == naive(later)


def test_a_table_rebuilt_without_rows_is_empty(spark, folder):
    table = Warehouse(spark, folder).table("t", schemas.DIM_COMPANY)
    assert not table.exists() and table.read().count() == 0
    for rows in ([("1", "a"), ("2", "b")], [("3", "c")], [], [("4", "d")]):
        table.overwrite(spark.createDataFrame(rows, schemas.DIM_COMPANY))
        assert table.exists() and sorted(map(tuple, table.read().collect())) == rows
    table.overwrite(table.read().where("company_id > 9"))
    assert table.exists() and table.read().count() == 0


def test_a_repeated_key_takes_its_last_record(spark, folder):
    records = [{**A1, "url": f"u{i}"} for i in range(5)]
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    kept = run_source(warehouse, SOURCE_A, dump(folder, "a", records), clock=at(T0))
    assert kept == 5  # rows of the batch, as landed; the key is stored once
    assert [p["url"] for p, _, _ in raw(warehouse).values()] == ["u4"]


def test_empty_batch(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    assert run_source(warehouse, SOURCE_B, dump(folder, "b", {"jobs": []}), clock=at(T0)) == 0
    assert raw(warehouse, "remotive") == {}
    assert raw_table(warehouse, "remotive").exists()
    assert last_run(warehouse).records_fetched == 0


def test_failed_read_is_logged_with_nothing_fetched(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_source(warehouse, SOURCE_A, f"{folder}/nowhere", clock=at(T0))
    run = last_run(warehouse)
    assert (run.records_fetched, run.records_upserted, run.status) == (0, 0, "failed")
    assert "PATH_NOT_FOUND" in run.error_message


def test_failure_after_the_read_is_logged_and_raised(spark, folder, monkeypatch):
    warehouse = Warehouse(spark, f"{folder}/warehouse")

    def broken(*_):
        raise RuntimeError("table down")

    monkeypatch.setattr(ingest, "upsert_table", broken)
    with pytest.raises(RuntimeError, match="table down"):
        run_source(warehouse, SOURCE_A, dump(folder, "a", DUMP_A), clock=at(T0))
    run = last_run(warehouse)
    assert (run.records_fetched, run.records_upserted, run.status) == (4, 0, "failed")
    assert run.error_message == "table down"


def test_a_failing_log_never_hides_the_error(spark, folder, monkeypatch):
    def no_log(*_, **__):
        raise OSError("log down")

    monkeypatch.setattr(ingest, "log_run", no_log)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_source(Warehouse(spark, f"{folder}/w"), SOURCE_A, f"{folder}/nowhere", clock=at(T0))


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, folder):
    warehouse = land(spark, folder)
    table = raw_table(warehouse, "remoteok")
    before = raw(warehouse)
    broken = table.read().withColumn("payload", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.replace_parts(broken, F.to_date("first_seen_at"))
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken)
    assert raw(warehouse) == before


def test_streamed_files_land_once(spark, folder):
    from postlode.streaming.landing import land_arriving

    warehouse = Warehouse(spark, f"{folder}/warehouse")

    def drop(name, *records):
        import os

        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{name}", "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r) + "\n" for r in records)

    drop("1.jsonl", *DUMP_A)
    land_arriving(warehouse, SOURCE_A, f"{folder}/in", clock=at(T0)).awaitTermination()
    drop("2.jsonl", {**A1, "url": "later"})
    land_arriving(warehouse, SOURCE_A, f"{folder}/in", clock=at(T0 + DAY)).awaitTermination()
    land_arriving(warehouse, SOURCE_A, f"{folder}/in", clock=at(T0 + 2 * DAY)).awaitTermination()
    got = raw(warehouse)
    assert got["remoteok_tern-1"] == ({**A1, "url": "later"}, naive(T0), naive(T0 + DAY))
    assert got["remoteok_tern-3"][1:] == (naive(T0), naive(T0))
