"""Connected routes: which neighbouring roots do not meet, and which roots run against their connected route.

A root's direction follows from the one before it, which may be free (the first root, or one after a break), settled as it
stands, or settled in reverse. What a root makes of these three states is a small function; functions of neighbours compose,
so every root learns its state from a prefix composition: each doubles the stretch of roots that it covers, until that begins
at the first root or no longer depends on what lies before. No list of roots is made and no task holds a connected route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import ensure_checkpoints

#: States of a root.
FREE, AHEAD, BACK = 0, 1, 2


def _steps(listed: DataFrame) -> DataFrame:
    """For each root after the first, what each state of the one before leads to: array of structs state, broken, flips (the
    root before is turned), by the state of the one before."""
    along = Window.partitionBy("con_id").orderBy("root_order")
    before = lambda c: F.lag(c).over(along)
    rows = listed.select("*", before("root").alias("before"), before("a").alias("qa"), before("b").alias("qb"), before("n").alias("qn"), F.lead("a").over(along).alias("na"), F.lead("b").over(along).alias("nb"))

    def step(state: int) -> Column:
        end, begin = ("qa", "qb") if state == BACK else ("qb", "qa")
        free = F.lit(state == FREE)
        to = lambda s, broken=False, flips=False: F.struct(F.lit(s).alias("state"), F.lit(broken).alias("broken"), F.lit(flips).alias("flips"))
        goes_on = F.col("na").isNotNull() & ((F.col("b") == F.col("na")) | (F.col("b") == F.col("nb")))
        return (
            F.when((F.col("qn") < 2) | (F.col("n") < 2) | (F.col("a") == F.col(end)), to(AHEAD))
            .when((F.col(end) == F.col("b")) & (F.col(begin) == F.col("a")) & free & goes_on, to(AHEAD, flips=True))
            .when(F.col(end) == F.col("b"), to(BACK))
            .when((F.col(begin) == F.col("b")) & free, to(BACK, flips=True))
            .when((F.col(begin) == F.col("a")) & free, to(AHEAD, flips=True))
            .otherwise(to(FREE, broken=True))
        )

    return rows.where("before IS NOT NULL").select("con_id", "root_order", "root", "before", F.array(step(FREE), step(AHEAD), step(BACK)).alias("steps"))


def directions(listed: DataFrame) -> DataFrame:
    """listed: con_id, root_order (0, 1, 2, ...), root, a, b (structs lat, lng of the ends), n (points). Rows con_id,
    root_order, root, before, broken (it does not meet the root before), reversed."""
    ensure_checkpoints(listed)
    steps = _steps(listed).checkpoint()
    settled = F.size(F.array_distinct("f")) == 1
    told = steps.select("con_id", "root_order", F.transform("steps", lambda s: s["state"]).alias("f"), F.col("root_order").alias("low"))
    done, open_ = None, told
    while True:
        # a function that depends on nothing, or begins at the first root, which is free, tells its root's state
        known = open_.where(settled | (F.col("low") <= 1)).select("con_id", "root_order", F.get("f", F.lit(FREE)).alias("state"))
        done = known if done is None else done.unionByName(known)
        open_ = open_.where(~settled & (F.col("low") > 1))
        if open_.isEmpty():
            break
        # the stretch before, as it stands in this round: of open roots its function, of settled ones their state
        state = done.select("con_id", F.col("root_order").alias("_o"), F.array("state", "state", "state").alias("g"), F.lit(1).alias("_l"))
        earlier = open_.select("con_id", F.col("root_order").alias("_o"), F.col("f").alias("g"), F.col("low").alias("_l")).unionByName(state)
        joined = open_.withColumn("_o", F.col("low") - 1).join(earlier, ["con_id", "_o"])
        open_ = joined.select("con_id", "root_order", F.transform("g", lambda s: F.get("f", s)).alias("f"), F.col("_l").alias("low")).checkpoint()
        done = done.checkpoint()
    first = listed.select("con_id", "root_order").where("root_order = 0").withColumn("state", F.lit(FREE))
    states = done.unionByName(first)
    at = states.select("con_id", (F.col("root_order") + 1).alias("root_order"), F.col("state").alias("prior"))
    taken = steps.join(at, ["con_id", "root_order"]).select("con_id", "root_order", "before", F.get("steps", F.col("prior")).alias("s"))
    turned = taken.where("s.flips").select("con_id", (F.col("root_order") - 1).alias("root_order"), F.lit(True).alias("flipped"))
    rows = listed.select("con_id", "root_order", "root").join(taken, ["con_id", "root_order"], "left").join(turned, ["con_id", "root_order"], "left")
    return rows.select("con_id", "root_order", "root", "before", F.coalesce("s.broken", F.lit(False)).alias("broken"), (F.coalesce(F.col("s.state") == BACK, F.lit(False)) | F.coalesce("flipped", F.lit(False))).alias("reversed"))


def disconnected(listed: DataFrame) -> DataFrame:
    """Rows con_id, root, before for each break."""
    return directions(listed).where("broken").select("con_id", "root", "before")
