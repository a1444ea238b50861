"""Band and radius joins over a grid of cells, so that nearness is an equi-join with a residual check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import RADIUS, cosine_miles, longitude_reach, nearby
from ..functions.text import fifteen_digits

#: Cells are a little wider than the tolerance, against rounding at their borders.
SLACK = 1.002


def near_misses(points: DataFrame, tolerance: float) -> DataFrame:
    """Pairs (both directions) of different coordinates less than the tolerance apart on both axes. points: name, lat, lng."""
    cell = lambda c: F.floor(F.col(c) / (SLACK * tolerance))
    here = points.select("name", "lat", "lng", cell("lat").alias("y"), cell("lng").alias("x"))
    around = F.array(*[F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    other = here.select(F.col("name").alias("other"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"), F.explode(around).alias("c")).select("other", "lat2", "lng2", "c.y", "c.x")
    joined = here.join(other, ["y", "x"])
    differs = (F.col("lat") != F.col("lat2")) | (F.col("lng") != F.col("lng2"))
    return joined.where(nearby(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2"), tolerance) & differs).select("name", "lat", "lng", "other", "lat2", "lng2")


def near_miss_lines(pairs: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """One line for each point and its later-named near misses: name, others, line, fp, n_intentional. marks: line."""
    ordered = pairs.where("name < other")
    close = (F.abs(F.col("lat") - F.col("lat2")) < 0.0000015) & (F.abs(F.col("lng") - F.col("lng2")) < 0.0000015)
    per = ordered.groupBy("name").agg(F.array_sort(F.collect_list("other")).alias("others"), F.count_if(close).alias("n_intentional"))
    told = per.withColumn("line", F.concat(F.col("name"), F.lit(" NMP "), F.concat_ws(" ", "others")))
    if marks is None:
        return told.withColumn("fp", F.lit(False))
    return told.join(marks.select("line", F.lit(True).alias("fp")).distinct(), "line", "left").withColumn("fp", F.coalesce("fp", F.lit(False)))


def pair_lines(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Two lines for each pair of near misses: name, other, line; FP tells that the first point's line (lines: name, fp) is marked, LI that
    the two look alike by intention."""
    close = (F.abs(F.col("lat") - F.col("lat2")) < 0.0000015) & (F.abs(F.col("lng") - F.col("lng2")) < 0.0000015)
    told = pairs.where("name < other").join(lines.select("name", "fp"), "name")
    mark = F.when(F.col("fp") | close, F.concat(F.lit(" "), F.when(F.col("fp"), "FP").otherwise(""), F.when(close, "LI").otherwise(""))).otherwise("")
    place = lambda name, lat, lng: F.concat(F.concat_ws(" ", name, fifteen_digits(F.col(lat)), fifteen_digits(F.col(lng))), mark)
    return told.select("name", "other", F.explode(F.array(place("name", "lat", "lng"), place("other", "lat2", "lng2"))).alias("line"))


def merged(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """Points moved to the northernmost latitude and easternmost longitude of themselves and their near misses."""
    best = pairs.groupBy("name").agg(F.max("lat2").alias("lat2"), F.max("lng2").alias("lng2"))
    joined = points.join(best, "name", "left")
    return joined.select("name", F.greatest("lat", "lat2").alias("lat"), F.greatest("lng", "lng2").alias("lng"), F.col("lat2").isNotNull().alias("moved"))


#: Height of the smallest cells in degrees, and how often it doubles at most.
CELL, LEVELS = 0.5, 9


def _columns(band: Column, height: Column) -> Column:
    """How many cells a band of latitude is cut into: as wide as high at its middle, so few near the poles, where one is a cap."""
    middle = (band + 0.5) * height
    return F.greatest(F.floor(F.cos(F.radians(F.least(F.abs(middle), F.lit(90.0)))) * 360 / height), F.lit(1)).cast("long")


def _height(level: Column) -> Column:
    return F.lit(CELL) * F.pow(F.lit(2.0), level)


def _column(lng: Column, columns: Column) -> Column:
    """The cell that a longitude falls into, counted on over the date line."""
    return F.floor((lng + 180) / 360 * columns)


def circle_cells(circles: DataFrame) -> DataFrame:
    """All cells that each circle may touch: level, band, cell and the circle's columns. A circle takes the level whose cells are
    about as high as its radius, so it has few cells, however large it is; with a pole inside it takes whole bands."""
    half = F.degrees(F.col("radius") / F.lit(RADIUS)) * 1.0001 + 1e-6
    level = F.least(F.greatest(F.ceil(F.log2(half / CELL)), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    sized = circles.withColumns({"_half": half, "level": level}).withColumn("_h", _height(F.col("level")))
    low, high = F.greatest(F.col("clat") - F.col("_half"), F.lit(-90.0)), F.least(F.col("clat") + F.col("_half"), F.lit(90.0))
    banded = sized.withColumn("band", F.explode(F.sequence(F.floor(low / F.col("_h")), F.floor(high / F.col("_h")))))
    n, reach = F.col("_n"), F.col("_reach")
    placed = banded.withColumns({"_n": _columns(F.col("band"), F.col("_h")), "_reach": longitude_reach(F.col("clat"), F.col("radius")) * 1.0001 + 1e-6})
    first, last = _column(F.col("clng") - reach, n), _column(F.col("clng") + reach, n)
    all_of = (reach >= 180) | (last - first + 1 >= n)
    cells = F.when(all_of, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, n)))
    return placed.withColumn("cell", F.explode(cells)).drop("_half", "_h", "_n", "_reach")


def within(places: DataFrame, circles: DataFrame) -> DataFrame:
    """Places inside circles: graph, name, miles. places: name, lat, lng; circles: graph, clat, clng, radius (miles).

    Places meet circles by an equi-join on cells of latitude and longitude, at each level that a circle takes; what stands in
    a cell is checked exactly. Circles over a pole or the date line need nothing special."""
    spread = circle_cells(circles)
    levels = spread.agg(F.array_sort(F.collect_set("level")).alias("_levels"))  # one row of at most LEVELS numbers
    at = places.crossJoin(F.broadcast(levels)).withColumn("level", F.explode("_levels")).drop("_levels")
    height = _height(F.col("level"))
    banded = at.withColumn("band", F.floor(F.col("lat") / height))
    n = _columns(F.col("band"), height)
    joined = banded.withColumn("cell", F.pmod(_column(F.col("lng"), n), n)).join(spread, ["level", "band", "cell"])
    miles = cosine_miles(F.col("lat"), F.col("lng"), F.col("clat"), F.col("clng"))
    return joined.withColumn("miles", miles).where("miles <= radius").select("graph", "name", "miles")


def edges_within(edges: DataFrame, circles: DataFrame) -> DataFrame:
    """Edges with both ends inside circles: graph, edge. edges: edge, a, b (structs lat, lng): matched ends are counted."""
    ends = edges.select("edge", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("a").alias("at")), F.struct(F.lit(1).alias("k"), F.col("b").alias("at")))).alias("e"))
    found = within(ends.select(F.struct("edge", "e.k").alias("name"), "e.at.lat", "e.at.lng"), circles)
    return found.groupBy("graph", F.col("name.edge").alias("edge")).agg(F.count("*").alias("n")).where("n = 2").select("graph", "edge")
