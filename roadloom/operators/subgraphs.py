"""Graph specs and what belongs to each of their graphs, for all specs at once.

A spec names regions, systems and a circle, any of them or none; its graph holds what lies in one of the regions, in one of
the systems and in the circle. Each name is a demand (graph, dimension, code) and each vertex or edge has traits (dimension,
code), so one equi-join of traits and demands and one aggregate tell which graphs each of them meets in every dimension that
the graph names: a relational division, whatever the number of specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spatial

#: One bit for each dimension.
REGION, SYSTEM, CIRCLE = 1, 2, 4

SPEC = "graph string, description string, category string, regions array<string>, systems array<string>, lat double, lng double, radius double"


def _wanted() -> Column:
    some = lambda test, bit: F.when(test, bit).otherwise(0)
    return some(F.size("regions") > 0, REGION) + some(F.size("systems") > 0, SYSTEM) + some(F.col("radius").isNotNull(), CIRCLE)


def demands(specs: DataFrame) -> DataFrame:
    """graph, bit, code, wanted (the bits of all dimensions that the graph names)."""
    of = lambda bit, codes: F.transform(codes, lambda c: F.struct(F.lit(bit).alias("bit"), c.alias("code")))
    circle = F.when(F.col("radius").isNotNull(), F.array(F.col("graph"))).otherwise(F.array().cast("array<string>"))
    rows = specs.select("graph", _wanted().alias("wanted"), F.explode(F.concat(of(REGION, F.col("regions")), of(SYSTEM, F.col("systems")), of(CIRCLE, circle))).alias("d"))
    return rows.select("graph", "d.bit", "d.code", "wanted").distinct()


def members(traits: DataFrame, specs: DataFrame, key: list[str]) -> DataFrame:
    """graph and key columns of everything that meets all its graph's dimensions. traits: key, bit, code; a trait of the circle
    has the graph as its code. Graphs that name nothing hold everything."""
    # a list of specs is small, and few codes are named by all rows
    met = traits.join(F.broadcast(demands(specs)), ["bit", "code"]).groupBy("graph", "wanted", *key).agg(F.bit_or("bit").alias("bits")).where("bits = wanted")
    open_ = specs.where(_wanted() == 0).select("graph")
    # few specs name nothing (the master graph): each of them holds all keys
    return met.select("graph", *key).unionByName(traits.select(*key).distinct().crossJoin(F.broadcast(open_)).select("graph", *key))


def circles(specs: DataFrame) -> DataFrame:
    return specs.where("radius IS NOT NULL").select("graph", F.col("lat").alias("clat"), F.col("lng").alias("clng"), "radius")


def vertices(points: DataFrame, specs: DataFrame) -> DataFrame:
    """graph, lat, lng. points: lat, lng, region, system of all active and preview routes."""
    trait = lambda bit, code: F.struct(F.lit(bit).alias("bit"), F.col(code).alias("code"))
    own = points.select("lat", "lng", F.explode(F.array(trait(REGION, "region"), trait(SYSTEM, "system"))).alias("t")).select("lat", "lng", "t.*").distinct()
    spots = points.select("lat", "lng").distinct().withColumn("name", F.struct("lat", "lng"))
    inside = spatial.within(spots, circles(specs)).select("name.lat", "name.lng", F.lit(CIRCLE).alias("bit"), F.col("graph").alias("code"))
    return members(own.unionByName(inside), specs, ["lat", "lng"])


def edges(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """graph, edge. rows: edge (any key), a, b (structs lat, lng), region (of the canonical segment), systems (of all members).
    Of a circle, an edge needs both ends inside."""
    region = F.array(F.struct(F.lit(REGION).alias("bit"), F.col("region").alias("code")))
    own = rows.select("edge", F.explode(F.concat(region, F.transform("systems", lambda s: F.struct(F.lit(SYSTEM).alias("bit"), s.alias("code"))))).alias("t")).select("edge", "t.*")
    inside = spatial.edges_within(rows.select("edge", "a", "b"), circles(specs)).select("edge", F.lit(CIRCLE).alias("bit"), F.col("graph").alias("code"))
    return members(own.unionByName(inside), specs, ["edge"])


def derived(mileage: DataFrame, systems: DataFrame) -> DataFrame:
    """Specs that follow from the data. mileage: region, country, continent of all regions with active or preview mileage;
    systems: system. Continents with a region, countries with two, every region, every system."""
    none = F.array().cast("array<string>")
    spec = lambda df, kind, code, title, regions, systems_: df.select(F.concat(code, F.lit(f"-{kind}")).alias("graph"), title.alias("description"), F.lit(kind).alias("category"), regions.alias("regions"), systems_.alias("systems"), *(F.lit(None).cast("double").alias(c) for c in ("lat", "lng", "radius")))
    # an area's list of regions is its spec itself
    of = lambda c: mileage.select(F.col(c).alias("code"), "region").distinct().groupBy("code").agg(F.array_sort(F.collect_set("region")).alias("r"))
    code = F.col("code")
    out = spec(of("continent"), "continent", code, F.concat(code, F.lit(" All Routes on Continent")), F.col("r"), none)
    out = out.unionByName(spec(of("country").where("size(r) >= 2"), "country", code, F.concat(code, F.lit(" All Routes in Country")), F.col("r"), none))
    regions = mileage.select(F.col("region").alias("code")).distinct()
    out = out.unionByName(spec(regions, "region", code, code, F.array(code), none))
    return out.unionByName(spec(systems.select(F.col("system").alias("code")).distinct(), "system", code, code, none, F.array(code)))


def named(specs: DataFrame) -> DataFrame:
    """Specs with format, filename and tag (what a progress line calls the graph), once for each of the three formats."""
    title = F.regexp_replace(F.regexp_replace("graph", "-area$", ""), F.concat(F.col("radius").cast("long").cast("string"), F.lit("$")), F.lit(""))
    kind = lambda x: F.col("category") == x
    tag = (
        F.when(kind("master"), "")
        .when(kind("area"), F.concat(title, F.lit("("), F.regexp_replace(F.col("radius").cast("string"), r"\.0$", ""), F.lit(") ")))
        .when(kind("region"), F.concat(F.get("regions", F.lit(0)), F.lit(" ")))
        .when(kind("system"), F.concat(F.get("systems", F.lit(0)), F.lit(" ")))
        .when(kind("country") | kind("continent"), F.concat(F.regexp_replace("graph", "-(country|continent)$", ""), F.lit(" ")))
        .otherwise(F.concat("graph", F.lit(" ")))
    )
    each = specs.withColumn("format", F.explode(F.array(F.lit("simple"), F.lit("collapsed"), F.lit("traveled"))))
    ending = F.when(F.col("format") == "collapsed", "").otherwise(F.concat(F.lit("-"), "format"))
    return each.withColumns({"filename": F.concat("graph", ending, F.lit(".tmg")), "tag": tag})
