"""Dense numbers over a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import ensure_checkpoints


def dense(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds 0, 1, 2, ... in the order of the columns: range-partitioned, numbered inside, moved by the counts before."""
    return _running(rows, [F.col(c) for c in order], F.lit(1), name)


def dense_by(rows: DataFrame, key: str, head: Column, order: list[str], name: str) -> DataFrame:
    """The same for rows of a key that are in order by a text of it (head), and then by the columns. What comes before a key is told
    by sums alone, so rows are shuffled once and neither drawn from nor stored. A key's rows are ordered in one task."""
    starts = _running(rows.groupBy(key).agg(F.count("*").alias("_c")).withColumn("_h", head), [F.col("_h")], F.col("_c"), "_before").select(key, "_before")
    inside = rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return inside.join(starts, key).select(*rows.columns, (F.col("_before") + F.col("_r") - 1).alias(name))


def running(rows: DataFrame, order: list[str], weight: Column, name: str) -> DataFrame:
    """Adds the sum of the weights of all rows before, in the order of the columns."""
    return _running(rows, [F.col(c) for c in order], weight, name)


def ranks(rows: DataFrame, value: str, name: str) -> DataFrame:
    """value, rank: of each different value how many rows have a larger one, and one more."""
    per = rows.groupBy(value).agg(F.count("*").alias("_c"))
    return _running(per, [F.col(value).desc()], F.col("_c"), name).select(value, (F.col(name) + 1).cast("int").alias(name))


def _running(rows: DataFrame, order: list[Column], weight: Column, name: str) -> DataFrame:
    """Adds the sum of the weights of all rows before, in the order given, without a single-task window."""
    ensure_checkpoints(rows)
    parted = rows.repartitionByRange(*order).withColumns({"_p": F.spark_partition_id(), "_w": weight})
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # range bounds are drawn anew in each run of a plan: the checkpoint makes sure that sums and offsets see the same ones
    summed = parted.withColumn("_r", F.coalesce(F.sum("_w").over(inside), F.lit(0))).checkpoint()
    sums = summed.groupBy("_p").agg(F.sum("_w").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))  # one row for each partition
    return summed.join(F.broadcast(starts), "_p").withColumn(name, F.col("_r") + F.col("_s")).drop("_p", "_r", "_s", "_w")


def occurrences(rows: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """Adds 1, 2, 3, ... to the rows that are equal on the key, in the order given. Rows are range-partitioned by key and order and
    counted inside; a key that spans partitions goes on where the one before ended, so a crowded key is no single task."""
    ensure_checkpoints(rows)
    parted = rows.repartitionByRange(*key, *order).withColumn("_p", F.spark_partition_id())
    inside = Window.partitionBy("_p", *key).orderBy(*order)
    counted = parted.withColumn("_r", F.row_number().over(inside)).checkpoint()
    # at most a row for each key and partition, and of a key as many as partitions hold it
    sums = counted.groupBy(*key, "_p").agg(F.max("_r").cast("long").alias("_n"))
    before = Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*key, "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s")).where("_s > 0")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*key, "_p")]
    on = same[0]
    for x in same[1:]:
        on = on & x
    joined = counted.alias("a").join(starts.alias("b"), on, "left")
    return joined.select(*[F.col(f"a.{c}") for c in rows.columns], (F.col("a._r") + F.coalesce("b._s", F.lit(0))).alias(name))


def culled(lines: DataFrame, cull: DataFrame, order: list[str]) -> DataFrame:
    """Lines less one copy for each line of `cull`, the first copies going; the others keep their order. lines: line and the order's
    columns; cull: line."""
    gone = cull.groupBy("line").agg(F.count("*").alias("_gone"))
    numbered = occurrences(lines, ["line"], order, "_nth")
    return numbered.join(gone, "line", "left").where(F.col("_nth") > F.coalesce("_gone", F.lit(0))).select(*lines.columns)
