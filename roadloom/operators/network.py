"""Segments, colocation and concurrency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import haversine


def segments(points: DataFrame) -> DataFrame:
    """Consecutive points of a route: root, idx, both ends, length, and the key of the unordered pair of ends.

    Segments of equal ends have no key: they never share their way with others."""
    along = Window.partitionBy("root").orderBy("idx")
    return between(points.select("root", "idx", "lat", "lng", F.lead("lat").over(along).alias("lat2"), F.lead("lng").over(along).alias("lng2")))


def between(steps: DataFrame, *more: str) -> DataFrame:
    """The same from points that know the next one: root, idx, lat, lng, lat2, lng2 (null at the end), with more columns of theirs."""
    rows = steps.where("lat2 IS NOT NULL")
    here, there = F.struct("lat", "lng"), F.struct(F.col("lat2").alias("lat"), F.col("lng2").alias("lng"))
    length = haversine(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2"))
    return rows.select("root", "idx", "lat", "lng", "lat2", "lng2", *more, length.alias("length"), F.when(here != there, F.struct(F.least(here, there).alias("a"), F.greatest(here, there).alias("b"))).alias("pair"))


def colocated(points: DataFrame) -> DataFrame:
    """Coordinates with their number of points."""
    return points.groupBy("lat", "lng").agg(F.count("*").alias("n_points"))


def shares(named: DataFrame) -> DataFrame:
    """Segments with how many of the same pair there are: all, active, active or preview, in the system. named: segments with
    their routes' columns.

    Counts come from one aggregate of pairs and systems joined back, so a crowded pair is summed before the shuffle and its
    rows may be split."""
    counts = ["n_all", "n_active", "n_shown", "n_system"]
    per = groups(named).where("pair IS NOT NULL").groupBy("pk", "pair", "system").agg(*(F.first(c).alias(c) for c in counts))
    active, shown, one = (F.col("level") == "active").cast("long"), F.col("level").isin("active", "preview").cast("long"), F.lit(1).cast("long")
    joined = by_pair(named, per, "left", "system")
    return joined.select(*named.columns, *(F.coalesce(F.col(c), x).alias(c) for c, x in zip(counts, (one, active, shown, one), strict=True)))


def groups(named: DataFrame) -> DataFrame:
    """Segments summed by pair, system, level and region: n and length of them, and of the pair n_all, n_active, n_shown and
    n_system as in `shares`. named: segments with their routes' columns.

    Sums are made before the shuffle, so a crowded pair is a row for each system and region. Segments of equal ends have no
    pair and share with none; as they have no length, they count as one group without a pair. pk is the pair's hash: as first
    key of sorts and joins it tells nearly all pairs apart by one number."""
    keys = ["system", "level", "region"]
    # the sums go by plain numbers, which take less room than nested ends, and the pair is put together behind them
    ends = {f"_{e}{c}": F.col(f"pair.{e}.{c}") for e in "ab" for c in ("lat", "lng")}
    summed = named.select(*(v.alias(k) for k, v in ends.items()), *keys, "length").groupBy(*ends, *keys).agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    at = lambda e: F.struct(F.col(f"_{e}lat").alias("lat"), F.col(f"_{e}lng").alias("lng")).alias(e)
    pair = F.when(F.col("_alat").isNotNull(), F.struct(at("a"), at("b")))
    summed = keyed(summed.withColumn("pair", pair)).select("pk", "pair", *keys, "n", "length")
    of_pair, of_system, alone = Window.partitionBy("pk", "pair"), Window.partitionBy("pk", "pair", "system"), F.col("pair").isNull()
    n = lambda level, over=of_pair: F.when(alone, level.cast("long")).otherwise(F.sum(F.when(level, F.col("n")).otherwise(0)).over(over))
    is_active, is_shown = F.col("level") == "active", F.col("level").isin("active", "preview")
    return summed.withColumns({"n_all": n(F.lit(True)), "n_active": n(is_active), "n_shown": n(is_shown), "n_system": n(F.lit(True), of_system)})


def first_at(points: DataFrame) -> DataFrame:
    """The front point of every coordinate: the least root@label."""
    front = Window.partitionBy("lat", "lng").orderBy("root_label")
    return points.withColumn("root_label", F.concat_ws("@", F.col("root").cast("string"), "label")).withColumn("r", F.row_number().over(front)).where("r = 1").drop("r")


def keyed(rows: DataFrame) -> DataFrame:
    """With pk, the hash of the pair of ends."""
    return rows if "pk" in rows.columns else rows.withColumn("pk", F.xxhash64("pair"))


def by_pair(left: DataFrame, right: DataFrame, how: str = "inner", *more: str) -> DataFrame:
    """A join on the pair of ends (and more columns), its hash first; equality is that of the pair itself. The hash stays, as pk."""
    return keyed(left).join(keyed(right), ["pk", "pair", *more], how)
