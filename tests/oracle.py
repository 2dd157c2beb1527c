"""Run a registered query and its SQL twin, and compare the rows as sets with counts."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    )


def difference(df, con: duckdb.DuckDBPyConnection, sql: str):
    """(spark rows, sql rows, rows only in spark, rows only in sql); columns must agree."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = _rows(names, result.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    return sum(ours.values()), sum(theirs.values()), ours - theirs, theirs - ours
