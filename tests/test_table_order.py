"""The order of tables tells how many rows they have: they are counted without numbers, which cost a range sort and a checkpoint each."""

import os

import pytest

from roadloom.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_nothing_is_numbered_or_stored(spark, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "checkpoint", lambda *_: pytest.fail("rows were stored"))
    plan = QUERIES["snk01_table_order"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_" not in plan and plan.count("Relation [l_orderkey") <= 8


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_counts_are_those_of_the_tables(spark):
    from roadloom.plans import table_queries  # after all that it takes its tables from

    got = {r["name"]: (r["rows"], r["place"]) for r in QUERIES["snk01_table_order"](spark, FOLDER).collect()}
    some = [(k, t) for k, t in enumerate(table_queries.TABLES) if t[0] in ("segments", "connectedRouteRoots", "clinchedConnectedRoutes", "clinchedSystemMileageByRegion")]
    assert len(got) == len(table_queries.TABLES)
    for k, (name, of, _) in some:
        assert got[name] == (QUERIES[of](spark, FOLDER).count(), k)
