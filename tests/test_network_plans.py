"""What segments and their sums cost: items are dealt once by root, sorted once, and read once for segments with and without a pair."""

import os

import pytest
from pyspark.sql import functions as F

from roadloom.operators import checks, network
from roadloom.plans.catalog import QUERIES
from roadloom.sources import tables

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_items_are_read_dealt_and_sorted_once(spark):
    plan = QUERIES["a03_region_mileage"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 1 and "lead(lat" not in plan
    # items, and routes if they are not broadcast
    assert plan.count("Exchange hashpartitioning(root") <= 2 and "Exchange hashpartitioning(l_orderkey" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_steps_are_the_points(spark):
    told = network.segments(tables.points(spark, FOLDER))
    assert network.between(tables.steps(spark, FOLDER)).exceptAll(told).isEmpty() and told.count() > 0


def test_groups_with_and_without_pair(spark):
    rows = [(r, 0.0, 0.0, *to, s, lv, g) for r, (to, s, lv, g) in enumerate([((1.0, 1.0), "s", "active", "A"), ((1.0, 1.0), "s", "active", "A"), ((1.0, 1.0), "t", "devel", "B"), ((0.0, 0.0), "s", "active", "A"), ((0.0, 0.0), "t", "devel", "B")])]
    steps = spark.createDataFrame(rows, "root int, lat double, lng double, lat2 double, lng2 double, system string, level string, region string").withColumn("idx", F.lit(0))
    named = network.between(steps).join(steps.select("root", "system", "level", "region"), "root")
    got = {(r.pair is None, r.system, r.n, r.n_all, r.n_active, r.n_shown, r.n_system) for r in network.groups(named).collect()}
    assert got == {(False, "s", 2, 3, 2, 2, 2), (False, "t", 1, 3, 2, 2, 1), (True, "s", 1, 1, 1, 1, 1), (True, "t", 1, 1, 0, 0, 1)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_split_region_reads_items_once(spark, monkeypatch):
    # labels of both ends were two more joins with the points
    monkeypatch.setattr(checks, "split_region", lambda told, prefix: told)
    plan = QUERIES["snk14_split_region_log"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_self_references_meet_what_stands_there_once(spark):
    # eleven joins before, five of them of all asking points
    plan = QUERIES["dc26_label_selfref"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 9
