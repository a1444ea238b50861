"""User logs: lines are dealt by traveler once, not drawn from, stored or joined, and texts of routes are made behind their order."""

import os

import pytest
from pyspark.sql import functions as F

from roadloom.functions.text import of_miles
from roadloom.operators import userlog
from roadloom.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_lines_are_dealt_once(spark):
    plan = QUERIES["snk06_user_logs"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Union")]
    assert "rangepartitioning" not in plan and "Join" not in top and top.count("Exchange") == 1


def test_blocks_of_connected_routes(spark):
    keys = {"section": 4, "a": "s", "sub": 4, "b": "", "e": 1}
    rows = [  # a connected route of two roots that are both driven, one of two of which one is, and one of one root
        (1, 10, 1, 1.0, 2.0, 3.0, 4.0, 2, True, False), (1, 10, 2, 2.0, 2.0, 3.0, 4.0, 2, False, True),
        (1, 20, 3, 1.0, 1.0, 1.0, 5.0, 2, True, True), (1, 30, 4, 1.0, 1.0, 1.0, 1.0, 1, True, True),
    ]
    roots = spark.createDataFrame(rows, "traveler long, c long, d long, m double, root_miles double, con_m double, con_miles double, con_roots long, first boolean, last boolean")
    roots = roots.withColumns({k: F.lit(v) for k, v in keys.items()} | {"value": F.lit(None).cast("string")})
    head = userlog.line(spark.range(1).select(F.lit(1).cast("long").alias("traveler")), 4, F.lit("head"), a=F.lit("s"))
    tail = userlog.line(spark.range(1).select(F.lit(1).cast("long").alias("traveler")), 5, F.lit("tail"))
    got = [(r.line_no, r.value) for r in userlog.logs([tail, head, roots]).orderBy("line_no").collect()]
    assert got == list(enumerate(["head", "C10: 3.00 of 4.00 mi (75.00%)", "  R1: 1.00 of 2.00 mi (50.00%)", "  R2: 2.00 of 2.00 mi (100.00%)", "", "C20: 1.00 of 5.00 mi (20.00%)", "  R3: 1.00 of 1.00 mi (100.00%)", "", "C30: 1.00 of 1.00 mi (100.00%)", " (R4 only)", "tail"]))


def test_text_of_miles_is_short_enough_to_compile(spark):
    # a log line has three such texts in one stage, and a stage of over 64 KB of code is interpreted
    plan = spark.range(1).select((F.col("id") * 1.5).alias("p"), (F.col("id") * 2.5).alias("w")).select(of_miles(F.col("p"), F.col("w")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_divide") < 30
