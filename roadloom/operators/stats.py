"""Mileage split over concurrent segments, clinched routes and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import ensure_checkpoints
from .numbering import ranks


def active(length: str = "length") -> Column:
    return F.when(F.col("level") == "active", F.col(length) / F.col("n_active")).otherwise(F.lit(0.0))


def shown(length: str = "length") -> Column:
    """Active and preview segments count; each is split over all of them."""
    return F.when(F.col("level").isin("active", "preview"), F.col(length) / F.col("n_shown")).otherwise(F.lit(0.0))


def miles(value: Column, digits: int = 2) -> Column:
    return F.round(F.sum(value), digits)


def whole_miles(miles: Column) -> Column:
    """The sum of numbers of two decimals in whole miles: added exactly, so that a sum that ends in .50 doesn't hang on their order."""
    return F.round(F.sum(miles.cast("decimal(18,2)"))).cast("double")


def region_mileage(groups: DataFrame) -> DataFrame:
    return groups.groupBy("region").agg(miles(active()).alias("active_miles"), miles(shown()).alias("active_preview_miles"), miles(F.col("length") / F.col("n_all")).alias("overall_miles"))


def ranked(rows: DataFrame, values: dict[str, str], allowed: Column) -> DataFrame:
    """rank() by falling value among the allowed rows, for each value its column's name; others get -1. No task sees all
    rows: different values are counted, and their counts summed over ranges."""
    ensure_checkpoints(rows)
    out = rows.withColumn("_ok", F.coalesce(allowed, F.lit(False))).checkpoint()
    for value, name in values.items():
        place = ranks(out.where("_ok"), value, "_rank")
        out = out.join(place, value, "left").withColumn(name, F.when(F.col("_ok"), F.col("_rank")).otherwise(-1).cast("int")).drop("_rank")
    return out.drop("_ok")
