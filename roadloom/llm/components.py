"""Connected components of a large graph by contraction: no node list ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """edges: a, b (long). Rows (node, component) for every node of an edge; component is its least reachable node.

    Each round gives every node the least node next to it, doubles these pointers until they end at the roots of their
    trees, and keeps the edges between different roots. A root with an edge left joins another one, so the roots at least
    halve with each round, and doubling takes the logarithm of a tree's depth. Rounds are written to the shared folder,
    which cuts the lineage. No edges: no rows. Loops and repeated edges do no harm.
    """
    both = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    live = Durable(both, "edges")
    labels = Durable(live.df.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("component")), "labels")
    for _ in range(rounds):
        if live.df.isEmpty():
            break
        # the least neighbour, or itself: pointers go down, so they form trees
        ends = live.df.select(F.explode(F.array(F.struct("a", F.col("a").alias("to")), F.struct(F.col("b").alias("a"), F.col("a").alias("to")))).alias("e")).select("e.*")
        first = ends.groupBy("a").agg(F.min("to").alias("to"))
        pointer = _followed(Durable(first, "pointers"))
        fresh = Durable(labels.df.join(pointer.df, labels.df["component"] == pointer.df["a"], "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        pa_, pb = pointer.df.select("a", F.col("to").alias("ta")), pointer.df.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        left = live.df.join(pa_, "a").join(pb, "b").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a < b").distinct()
        after = Durable(left, "edges")
        for old in (live, labels, pointer):
            old.drop()
        live, labels = after, fresh
    else:
        raise RuntimeError("components did not settle")
    return labels.df


def _followed(pointer: Durable) -> Durable:
    """Pointers (a, to) doubled until each ends at a root."""
    while True:
        hop = pointer.df.select(F.col("a").alias("to"), F.col("to").alias("further"))
        further = Durable(pointer.df.join(hop, "to", "left").select("a", F.coalesce("further", "to").alias("to"), (F.coalesce("further", "to") != F.col("to")).alias("moved")), "pointers")
        moved = not further.df.where("moved").isEmpty()
        pointer.drop()
        pointer = further
        if not moved:
            return pointer
