"""Every registered query next to its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(df.columns) == len(set(df.columns))
    if name in ORACLES:
        cur = sql.execute(ORACLES[name])
        assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "category", "n_spans", "n_docs", "n_chars"]
    assert set(ORACLES) <= set(QUERIES)
