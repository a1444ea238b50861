"""Queries on nearness, places, distances and map projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G  # noqa: N812
from ..operators import spatial
from ..sources import tables
from .registry import query

TOLERANCE = 0.005
_PT = "WITH p AS (SELECT 'v' || vec_id AS name, vec_id, label, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng FROM embeddings), nm AS (SELECT a.name, a.lat, a.lng, b.name AS other, b.lat AS lat2, b.lng AS lng2 FROM p a JOIN p b ON abs(a.lat - b.lat) < 0.005 AND abs(a.lng - b.lng) < 0.005 AND (a.lat <> b.lat OR a.lng <> b.lng)) "


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda k: F.get("embedding", F.lit(k)).cast("double")
    return tables.read(spark, sf_dir, "embeddings").select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"), "vec_id", "label", at(0).alias("lat"), at(1).alias("lng"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.near_misses(points(spark, sf_dir), TOLERANCE)


@query("j08_near_miss_pairs", _PT + "SELECT name, other FROM nm", base=False)
def near_miss_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("name", "other")


_LINES = """, l AS (SELECT name, name || ' NMP ' || string_agg(other, ' ' ORDER BY other) AS line, count(*) FILTER (abs(lat - lat2) < 0.0000015 AND abs(lng - lng2) < 0.0000015) AS n FROM nm WHERE name < other GROUP BY name) """


@query("j09_near_miss_flags", _PT + _LINES + "SELECT name, line, CAST(substr(name, 2) AS BIGINT) % 2 = 0 AS fp, CAST(n AS BIGINT) AS n_intentional FROM l", base=False)
def near_miss_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of even points are marked."""
    found = pairs(spark, sf_dir)
    marks = spatial.near_miss_lines(found).where(F.substring("name", 2, 20).cast("long") % 2 == 0).select("line")
    return spatial.near_miss_lines(found, marks).select("name", "line", "fp", "n_intentional")


@query("snk09_near_miss_log", _PT + _LINES + "SELECT line FROM l", base=False)
def near_miss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.near_miss_lines(pairs(spark, sf_dir)).select("line").orderBy("line")


@query("snk10_merged_points", _PT + "SELECT p.name, greatest(p.lat, max(nm.lat2)) AS lat, greatest(p.lng, max(nm.lng2)) AS lng FROM p LEFT JOIN nm USING (name) GROUP BY p.name, p.lat, p.lng", base=False)
def merged_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.merged(points(spark, sf_dir).select("name", "lat", "lng"), pairs(spark, sf_dir)).select("name", "lat", "lng")


@query("a19_near_miss_regions", _PT + """, q AS (SELECT nm.*, a.label AS r1, b.label AS r2 FROM nm JOIN p a ON nm.name = a.name JOIN p b ON nm.other = b.name WHERE nm.name < nm.other), e AS (SELECT CAST(r1 AS VARCHAR) AS region, name FROM q UNION ALL SELECT CAST(r2 AS VARCHAR), name FROM q WHERE r1 <> r2 UNION ALL SELECT 'total', name FROM q)
SELECT region, CAST(count(*) FILTER (CAST(substr(name, 2) AS BIGINT) % 2 = 1) AS BIGINT) AS unmarked, CAST(count(*) FILTER (CAST(substr(name, 2) AS BIGINT) % 2 = 0) AS BIGINT) AS fp FROM e GROUP BY region""", base=False)
def near_miss_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    of = lambda n, c: p.select(F.col("name").alias(n), F.col("label").cast("string").alias(c))
    found = pairs(spark, sf_dir).where("name < other").join(of("name", "r1"), "name").join(of("other", "r2"), "other")
    each = found.select("name", F.explode(F.concat(F.array_distinct(F.array("r1", "r2")), F.array(F.lit("total")))).alias("region"))
    even = F.substring("name", 2, 20).cast("long") % 2 == 0
    return each.groupBy("region").agg(F.count_if(~even).alias("unmarked"), F.count_if(even).alias("fp")).orderBy(F.desc("unmarked"))


@query("set06_near_miss_filters", _PT + "SELECT name, other FROM nm JOIN p USING (name) WHERE p.label IN (1, 2) AND vec_id % 2 = 1 AND name < other", base=False)
def near_miss_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmarked pairs of which the first point lies in one of two countries."""
    keep = points(spark, sf_dir).where(F.col("label").isin(1, 2) & (F.col("vec_id") % 2 == 1)).select("name")
    return pairs(spark, sf_dir).where("name < other").join(keep, "name", "left_semi").select("name", "other")


_PLACES = "WITH s AS (SELECT s_suppkey, ((s_suppkey * 7919) % 1000) / 10 - 50 AS lat, ((s_suppkey * 104729) % 3000) / 10 - 150 AS lng FROM supplier), c AS (SELECT 'g' || n_nationkey AS graph, n_nationkey * 3.0::DOUBLE - 40 AS clat, n_nationkey * 14.0::DOUBLE - 178 AS clng, 300.0::DOUBLE + 150 * n_nationkey AS radius FROM nation) "
_MILES = "acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, cos(radians(lat)) * cos(radians(clat)) * cos(radians(clng) - radians(lng)) + sin(radians(lat)) * sin(radians(clat))))) * 3963.1::DOUBLE"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return tables.read(spark, sf_dir, "supplier").select(s.alias("name"), tables.lat_of(s).alias("lat"), tables.lng_of(s).alias("lng"))


def circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return tables.read(spark, sf_dir, "nation").select(F.concat(F.lit("g"), n.cast("string")).alias("graph"), (n * 3.0 - 40).alias("clat"), (n * 14.0 - 178).alias("clng"), (300.0 + n * 150).alias("radius"))


@query("j10_radius_join", _PLACES + f""", w AS (SELECT graph, s_suppkey AS name, round({_MILES}, 3) AS miles FROM s, c WHERE {_MILES} <= radius)
SELECT graph, 'vertex' AS kind, name, miles FROM w UNION ALL SELECT x.graph, 'edge', x.name, NULL FROM w x JOIN w y ON x.graph = y.graph AND y.name = x.name + 1""", base=False)
def radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places inside circles, and the ways from a place to the next one of which both ends lie inside."""
    spots, rings = places(spark, sf_dir), circles(spark, sf_dir)
    spot = F.struct("lat", "lng")
    to = spots.select((F.col("name") - 1).alias("edge"), spot.alias("b"))
    ways = spots.select(F.col("name").alias("edge"), spot.alias("a")).join(to, "edge")
    inside = spatial.within(spots, rings).select("graph", F.lit("vertex").alias("kind"), "name", F.round("miles", 3).alias("miles"))
    return inside.unionByName(spatial.edges_within(ways, rings).select("graph", F.lit("edge").alias("kind"), F.col("edge").alias("name"), F.lit(None).cast("double").alias("miles")))


@query("fn01_haversine", "SELECT root, idx, round(len / 1.02112, 4) AS miles FROM seg")
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.network import segments

    return segments(tables.points(spark, sf_dir)).select("root", "idx", F.round(F.col("length") / 1.02112, 4).alias("miles"))


@query("fn02_turn_angle", "SELECT s_suppkey, round(degrees(acos(greatest(-1, least(1, cos(radians(lat)) * 1.0)))), 4) AS angle FROM (SELECT s_suppkey, abs(((s_suppkey * 7919) % 1000) / 10 - 50) AS lat FROM supplier) WHERE lat > 0", base=False)
def turn_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out along the equator by twice the latitude and back by half the turn: the angle between chords is the latitude."""
    lat = F.abs(tables.lat_of(F.col("s_suppkey")))
    angle = G.turn_angle(F.lit(0.0), -lat, F.lit(0.0), F.lit(0.0), F.lit(0.0), lat)
    return tables.read(spark, sf_dir, "supplier").where(lat > 0).select("s_suppkey", F.round(angle, 4).alias("angle"))


@query("fn03_cosine_miles", _PLACES + f"SELECT s_suppkey AS name, graph, round({_MILES}, 3) AS miles FROM s, c WHERE graph = 'g' || (s_suppkey % 25)", base=False)
def cosine_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = places(spark, sf_dir).join(circles(spark, sf_dir), F.concat(F.lit("g"), (F.col("name") % 25).cast("string")) == F.col("graph"))
    return joined.select("name", "graph", F.round(G.cosine_miles(F.col("lat"), F.col("lng"), F.col("clat"), F.col("clng")), 3).alias("miles"))


@query("fn04_nearby", _PT + "SELECT name, abs(lat - 0.05) < 0.1 AND abs(lng - 0.05) < 0.1 AS near, lat = lng AS same FROM p", base=False)
def nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.lit(0.05)
    return points(spark, sf_dir).select("name", G.nearby(F.col("lat"), F.col("lng"), half, half, 0.1).alias("near"), (F.col("lat") == F.col("lng")).alias("same"))


@query("fn06_bounding_boxes", _PLACES + "SELECT graph, round(degrees(radius / 3963.1), 4) AS lat_reach, round(CASE WHEN abs(radians(clat)) + radius / 3963.1 < pi() / 2 THEN degrees(asin(sin(radius / 3963.1) / cos(radians(clat)))) ELSE 180 END, 4) AS lng_reach FROM c", base=False)
def bounding_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circles(spark, sf_dir).select("graph", F.round(F.degrees(F.col("radius") / 3963.1), 4).alias("lat_reach"), F.round(G.longitude_reach(F.col("clat"), F.col("radius")), 4).alias("lng_reach"))


@query("fn13_wrapped", "SELECT p_partkey, CASE WHEN x > 90 THEN x - ceil((x - 90) / 360) * 360 WHEN x < -90 THEN x + ceil((-x - 90) / 360) * 360 ELSE x END AS lat, CASE WHEN x > 540 THEN x - ceil((x - 540) / 360) * 360 WHEN x < -540 THEN x + ceil((-x - 540) / 360) * 360 ELSE x END AS lng FROM (SELECT p_partkey, CAST((p_partkey % 2000) - 1000 AS DOUBLE) + 0.5 AS x FROM part)", base=False)
def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = (F.col("p_partkey") % 2000 - 1000).cast("double") + 0.5
    return tables.read(spark, sf_dir, "part").select("p_partkey", G.wrapped(x, 90.0).alias("lat"), G.wrapped(x, 540.0).alias("lng"))


@query("fn14_mercator", "SELECT s_suppkey, round(ln(tan(pi() / 4 + radians(lat) / 2)), 6) AS y, round(lat, 6) AS back FROM (SELECT s_suppkey, ((s_suppkey * 7919) % 1000) / 10 - 50 AS lat FROM supplier)", base=False)
def mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = G.mercator_y(tables.lat_of(F.col("s_suppkey")))
    return tables.read(spark, sf_dir, "supplier").select("s_suppkey", F.round(y, 6).alias("y"), F.round(G.mercator_latitude(y), 6).alias("back"))


@query("a17_bounding_box", "SELECT round(min(lat), 1) AS south, round(max(lat), 1) AS north, round(min(lng), 1) AS west, round(max(lng), 1) AS east FROM pts")
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tables.points(spark, sf_dir)
    return p.agg(*(F.round(f(c), 1).alias(n) for f, c, n in ((F.min, "lat", "south"), (F.max, "lat", "north"), (F.min, "lng", "west"), (F.max, "lng", "east"))))


