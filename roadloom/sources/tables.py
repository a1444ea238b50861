"""The driver tables seen as a route network, in the schemas that the native files give too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..shipping import ship


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(place: Column) -> Column:
    return ((place * 7919) % 1000) / 10 - 50


def lng_of(place: Column) -> Column:
    return ((place * 104729) % 3000) / 10 - 150


def level_of(priority: Column) -> Column:
    return F.when(priority.isin("1-URGENT", "2-HIGH"), "active").when(priority == "3-MEDIUM", "preview").otherwise("devel")


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """root, system, level, con_id, region, country, abbrev: the dimensions are small and broadcast by their size."""
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select("n_nationkey", F.col("n_name").alias("region"), F.col("r_name").alias("country"))
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.col("o_orderkey").alias("root"), F.col("o_orderpriority").alias("system"), level_of(F.col("o_orderpriority")).alias("level"), F.col("o_custkey").alias("con_id"), "region", "country", F.when(F.col("o_orderkey") % 3 == 1, "Cit").otherwise("").alias("abbrev"))


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, WindowSpec]:
    """Items with root, and their order in it. They are dealt by root under that name, so what goes by root later needs no other
    shuffle; coordinates and labels are told behind it."""
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("root"), "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    return items, Window.partitionBy("root").orderBy("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def _label(key: str, flag: str) -> Column:
    return F.concat(F.when(F.col(flag) == "R", "+X").otherwise("P"), F.col(key).cast("string"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """root, idx, lat, lng, is_hidden, label."""
    items, order = _items(spark, sf_dir)
    return items.withColumn("idx", F.row_number().over(order) - 1).select(
        "root",
        "idx",
        lat_of(F.col("l_suppkey")).alias("lat"),
        lng_of(F.col("l_suppkey")).alias("lng"),
        (F.col("l_returnflag") == "R").alias("is_hidden"),
        _label("l_suppkey", "l_returnflag").alias("label"),
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """root, idx, lat, lng, label, lat2, lng2, label2: the points of `points` with the next one's place and label (null at the end),
    told in the same order without another sort by idx."""
    items, order = _items(spark, sf_dir)
    placed = items.withColumns({"idx": F.row_number().over(order) - 1, "next": F.lead("l_suppkey").over(order), "flag": F.lead("l_returnflag").over(order)})
    at = lambda key, flag, s: [lat_of(F.col(key)).alias(f"lat{s}"), lng_of(F.col(key)).alias(f"lng{s}"), _label(key, flag).alias(f"label{s}")]
    return placed.select("root", "idx", *at("l_suppkey", "l_returnflag", ""), *at("next", "flag", "2"))


def entries(spark: SparkSession, sf_dir: str, lengths: DataFrame) -> DataFrame:
    """traveler, line_no, root, beg, end: a list entry for each event. lengths: root, n (points of each route)."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    joined = events.join(lengths, F.col("event_id") == F.col("root"))
    a, b = F.col("k") % F.col("n"), (3 * F.col("k") + 1) % F.col("n")
    return joined.select(F.col("user_id").alias("traveler"), F.col("event_id").alias("line_no"), "root", F.least(a, b).cast("int").alias("beg"), F.greatest(a, b).cast("int").alias("end"))
