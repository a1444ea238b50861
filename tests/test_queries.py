"""Every query that has SQL against it, on the smallest tables."""

import math
import os

import pytest

from roadloom.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in sorted(os.listdir(FOLDER)):
        con.sql(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    return con


def plain(rows):
    one = lambda x: None if isinstance(x, float) and math.isnan(x) else round(x, 6) + 0.0 if isinstance(x, float) else x
    return sorted((tuple(map(one, r)) for r in rows), key=str)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = plain(tuple(r[k] for k in at) for r in rel.fetchall())
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
