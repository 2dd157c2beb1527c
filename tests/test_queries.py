"""Every registered query against its SQL twin, over the driver's smallest tables."""

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import queries
import oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_its_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    ours, theirs, extra, missing = oracle.difference(df, con, entry.oracle_sql()[name])
    assert (ours, extra, missing) == (theirs, {}, {})


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.ORACLES) == set(queries.QUERIES)
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_large_regions_search_every_document(spark):
    tables = {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("benchmark", "documents")}
    keywords = {w for r in tables["benchmark"].collect() for w in re.findall(r"\w+", (r.text or "").lower())}
    expected = Counter({"Unspecified": 3})
    for r in tables["documents"].collect():
        found = {w[0] for w in re.findall(r"\w+", f"{r.source or ''} {r.text or ''}".lower()) if w in keywords}
        expected.update(found or ["Unspecified"])
    found = queries.QUERIES["bridge_region_every"](spark, SF_DIR).collect()
    assert len(keywords) > 200 and {r.region: r.n_documents for r in found} == expected
