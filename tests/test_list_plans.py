"""Joins of list lines with what routes explode to must not go through the driver: Spark takes exploded rows for few."""

import os

import pytest

from roadloom.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", ["tl02_chopped_status", "tl03_chopped_ranges", "tl04_connected_status", "tl05_connected_ranges", "tl06_segment_dedupe", "tl07_labels_in_use", "tl07_names_in_use", "j11_unused_alternates"])
def test_no_broadcast(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_good_lines(spark):
    # the one row for each traveler may be broadcast, the segments may not
    plan = QUERIES["tl10_good_lines"](spark, FOLDER)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") <= 1
