import sys

import corpus_pipeline
import duckdb
import pytest
from llm.helpers import documents, prose, same_rows
from pyspark.sql import functions as F

from postlode.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    with duckdb.connect() as db:
        for table in ("documents", "pages", "benchmark", "labels"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
        columns = ", ".join(found.columns)
        same_rows(found.collect(), db.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_classifier_learns_from_its_rows_alone(spark):
    scored = QUERIES["op8_compression_quality"](spark, SMALL)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert scored.where("score between 0 and 1 and predicted = cast(score >= 0.3 as int)").count() == scored.count()


@pytest.fixture
def corpus(spark, folder):
    """Documents of prose with copies, junk, a benchmark passage and odd rows, as a table folder."""
    good = [(i, prose(i, 80)) for i in range(60)]
    junk = [(200 + i, " ".join(w.upper() + "!!" for w in prose(i, 80).split())) for i in range(30)]
    rows = [*good, *junk, (300, good[2][1]), (301, good[2][1]), (302, "Start here. " + prose(999, 40) + " End here.")]
    rows += [(400 + (i or 0), t) for i, t in documents()[-10:]]
    extra = [(*r, "en", "src", 0 if r[1] is None else len(r[1])) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(extra, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i, _ in [*good, *junk]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(999, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_take_effect(spark, corpus, folder):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{n}"
        stage(spark, docs, corpus).write.parquet(path)
        docs = spark.read.parquet(path)
        if n < 4:
            assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    good = set(range(60))
    assert good <= kept[0] and not kept[0] & set(range(200, 230))
    assert kept[1] == kept[0]
    assert len(kept[2] & {2, 300, 301}) == 1 and good - {2} <= kept[2]
    assert 302 in kept[2] and 302 not in kept[3]
    assert kept[4] == kept[3]


def test_run_gives_the_pieces(spark, corpus):
    found = corpus_pipeline.run(spark, corpus)
    lengths = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas()
    assert (lengths.n <= 2048).all() and len(lengths)


def test_stages_bear_an_empty_table(spark, corpus):
    none = spark.read.parquet(f"{corpus}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, corpus).count() == 0


def test_rest_does_not_import_the_subpackage():
    import subprocess

    code = "import postlode.plans.daily, queries, sys; assert not [m for m in sys.modules if m.startswith('postlode.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rpartition("/")[0])

