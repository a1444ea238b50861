"""Numbers as C's printf writes them, and sums that don't hang on their order."""

import random

from pyspark.sql import functions as F

from roadloom.functions.text import fifteen_digits, fixed, of_miles
from roadloom.operators import stats


def test_fixed_as_printf(spark):
    rng = random.Random(7)
    values = [3.125, 1.005, 2.675, 0.125, 0.375, -0.005, -0.0, 0.0, 0.045, 100.0, 99.995, 1e12 + 0.125, 1e-9, 6.25, 0.05]
    values += [rng.randrange(10**7) / 1000 for _ in range(500)] + [rng.uniform(-1e6, 1e6) for _ in range(500)] + [rng.randrange(10**6) / 64 for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fixed(F.col("v"), 2).alias("two"), fixed(F.col("v"), 1).alias("one")).collect()
    assert [(r.v, r.two, r.one) for r in rows if (r.two, r.one) != (f"{r.v:.2f}", f"{r.v:.1f}")] == []


def test_of_miles_halves(spark):
    row = spark.range(1).select(of_miles(F.lit(29.0), F.lit(928.0)).alias("t")).first()
    assert row.t == "29.00 of 928.00 mi (3.12%)"


def test_fifteen_digits_with_exponents(spark):
    values = [5e-05, 4.3e-05, -1.25e-06, 1e-10, -0.0, 0.0, 0.0001, 1e15, 2.5e20, -3e-05]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fifteen_digits(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [f"{r.v:.15g}" for r in rows]


def test_whole_miles_of_a_half(spark):
    values = [0.12, 80.71, 18.81, 78.6, 34.26]  # their sum is a half; added as doubles it falls short of it in any order
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert rows.agg(stats.whole_miles(F.col("v")).alias("m")).first().m == 213.0
