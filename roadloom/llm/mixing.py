"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only.

Sizes are word counts. Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the whole volume by
weight; a source's target stops at `MOST` times its size, and what is left over is shared again by weight until no target
is above that. A source's rate is target / size: every document gets the whole part of it as certain copies, and the
fraction f is what is left for one more copy of some. A document's inclusion probability for that copy is
p = f * (mean size / size)**TILT: one more copy of a very long document would take the room of many others and throw the
total off. Ranks are q = u / (1 - u) : p / (1 - p) for a hash-derived u, and the sample, whose size in words is fixed
beforehand, is the run of lowest q whose words come nearest to what the certain copies leave open.

The rank order is cut into buckets whose sums are prefix-summed, so only the bucket in which a source's sample ends is ever
ordered row by row: a source with a third of all rows is no hot spot. Ties in q go by doc_id, then size. All figures
follow from the rows alone, so reruns agree.

Null texts have size 0; a source of size 0 has target 0 and its documents are taken 0 times. Repeated rows are rows of their
own: they share their draw, and are taken in the order of numbers that are written with their sizes. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable

MOST, BUCKETS, SEED, TILT = 3, 4096, 20, 0.5
#: Inclusion probabilities stay between these.
LEAST_P, MOST_P = 1e-9, 1 - 1e-6
#: Columns beside those of the documents.
_ROW, _COPIES, _COPY = "_mix_row", "_mix_copies", "_mix_copy"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """sizes: source, source_size (one row each). Adds target (double)."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * most)
    # fill all sources in proportion to weight; those with the least room for their weight are full first
    fill = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    upto, rest = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(rest))
    # that level rises while sources fill up and falls afterwards, so its peak is where the filling ends
    level = F.max("level").over(everything)
    full = F.col("cap") <= level * F.col("weight")
    return rows.select("source", "source_size", F.when(full, F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def rates(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """sized: source, size. One row for each source: target, certain copies, fraction f, mean size and words still open."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = targets(sums, weights, most).join(sums.select(F.col("source").alias("of"), (F.col("source_size") / F.col("n")).alias("mean")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    rows = per.withColumn("certain", F.floor(rate + 1e-12).cast("long")).withColumn("f", F.greatest(rate - F.col("certain"), F.lit(0.0)))
    return rows.withColumn("open", F.greatest(F.col("target") - F.col("certain") * F.col("source_size"), F.lit(0.0)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row; copies tells how often the mix holds it."""
    return _mixed(docs.withColumn(_ROW, F.monotonically_increasing_id()), weights, most, buckets).drop(_ROW)


def _mixed(rows: DataFrame, weights: tuple[int, ...], most: int, buckets: int = BUCKETS) -> DataFrame:
    """The same with each row's number, which is fixed once sizes are written."""
    slim = rows.select(_ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))
    sized = Durable(slim, "sizes").df
    rate = Durable(rates(sized, weights, most), "rates").df
    share = F.pmod(F.xxhash64(F.lit(SEED), F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("size")), F.lit(1 << 52)).cast("double")
    u = (share + 0.5) / float(1 << 52)
    p = F.greatest(F.lit(LEAST_P), F.least(F.lit(MOST_P), F.col("f") * F.pow(F.col("mean") / F.greatest(F.col("size"), F.lit(1)), F.lit(TILT))))
    odds = F.when(F.col("f") > 0, (u / (1 - u)) / (p / (1 - p)))
    rows = sized.join(rate, sized["source"].eqNullSafe(rate["source"])).select(sized["*"], "source_size", "target", "certain", "open", odds.alias("q"))
    # q / (1 + q) keeps the order of q and lies between 0 and 1
    rows = rows.withColumn("bucket", F.least(F.floor(F.col("q") / (1 + F.col("q")) * buckets), F.lit(buckets - 1)))
    sums = rows.where("q IS NOT NULL").groupBy("source", "open", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # the bucket in which the sample ends: the sum passes `open` there
    edge = sums.where("before <= open AND before + words > open").groupBy("source").agg(F.min("bucket").alias("edge"), F.min_by("before", "bucket").alias("before"))
    rows = rows.join(edge.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    inside = rows.where("bucket = edge")
    run = W.partitionBy("source").orderBy("q", "doc_id", "size", _ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = inside.withColumn("run", F.col("before") + F.sum("size").over(run))
    # a document is in while more than half of it lies below `open`
    inside = inside.withColumn("extra", (F.col("run") - F.col("size") / 2.0 <= F.col("open")).cast("long"))
    outside = rows.where("NOT coalesce(bucket = edge, false)").withColumn("extra", F.when(F.col("q").isNull(), 0).when(F.col("edge").isNull(), F.when(F.col("open") > 0, 1).otherwise(0)).otherwise((F.col("bucket") < F.col("edge")).cast("long")).cast("long"))
    columns = [_ROW, "doc_id", "source", "size", "source_size", "target", (F.col("certain") + F.col("extra")).alias("copies"), ((F.col("certain") + F.col("extra")) * F.col("size")).alias("taken")]
    return inside.select(*columns).unionByName(outside.select(*columns))


def apply(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of docs. Rows are numbered in a written copy, so
    equal rows are taken one by one, as in `mix`."""
    numbered = Durable(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered").df
    times = _mixed(numbered, weights, most).where("copies > 0").select(_ROW, F.col("copies").cast("int").alias(_COPIES))
    return numbered.join(times, _ROW).withColumn(_COPY, F.explode(F.sequence(F.lit(1), F.col(_COPIES)))).select(*docs.columns)
