"""Per-traveler logs: what was wrong with list lines, then mileage by region, system and route, then recent updates.

Every kind of line is a DataFrame of its own with sort keys; their union is dealt by traveler once and numbered by sums. What a
traveler has of routes, which is most of a log, goes there as numbers, and its texts are made behind the order. A traveler's lines
are ordered in one task (by a sort that spills), not stored and not drawn from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fixed, of_miles
from ..storage import ensure_checkpoints

SHOWN = "level IN ('active', 'preview')"
#: Where a line stands in its traveler's log.
KEYS = {"section": "int", "a": "string", "sub": "int", "b": "string", "c": "long", "d": "long", "e": "int"}
#: What the lines of a traveler's root and of its connected route tell.
ROOT = ["m", "root_miles", "con_m", "con_miles", "con_roots", "first", "last"]


def line(df: DataFrame, section: int, value: Column, a: str | Column = "", sub: int = 0, b: str | Column = "", c: Column | int = 0, d: Column | int = 0, e: int = 0, more: list[str] | None = None) -> DataFrame:
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    given = {"section": section, "a": a, "sub": sub, "b": b, "c": c, "d": d, "e": e}
    return df.select("traveler", *[col(x).cast(KEYS[k]).alias(k) for k, x in given.items()], value.alias("value"), *(more or []))


def several(df: DataFrame, section: int, values: list[tuple[int, int, Column]], a: str | Column = "") -> DataFrame:
    """Lines of one row: their places (sub, e) and values; null values are no lines."""
    told = F.explode(F.array(*(F.struct(F.lit(sub).alias("sub"), F.lit(e).alias("e"), v.alias("value")) for sub, e, v in values))).alias("x")
    rows = df.select("traveler", (a if isinstance(a, Column) else F.lit(a)).alias("a"), told).where("x.value IS NOT NULL")
    return rows.select("traveler", F.lit(section).alias("section"), "a", "x.sub", F.lit("").alias("b"), F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("d"), "x.e", "x.value")


def messages(resolved: DataFrame) -> DataFrame:
    """Lines for list entries of one route that could not be used: traveler, line_no, line, status, region, root and, as they were
    written, label1 and label2, with missing1, missing2, twice1, twice2 telling which of the labels is unknown or stands twice."""
    is_ = lambda x: F.col("status") == x
    # The texts of messages.
    end = F.concat(F.lit(" in line: "), "line")
    texts = (
        F.when(is_("unknown route"), F.array(F.concat(F.lit("Unknown region/highway combo"), end)))
        .when(is_("devel"), F.array(F.concat(F.lit("Ignoring line matching highway in system in development: "), "line")))
        .when(is_("both labels missing"), F.array(F.concat(F.lit("Waypoint labels "), "label1", F.lit(" and "), "label2", F.lit(" not found"), end)))
        .when(is_("label missing"), F.array(F.concat(F.lit("Waypoint label "), F.when(F.col("missing1"), F.col("label1")).otherwise(F.col("label2")), F.lit(" not found"), end)))
        .when(is_("duplicate label"), F.array_compact(F.array(*[F.when(F.col(f"twice{k}"), F.concat("region", F.lit(": duplicate label "), f"label{k}", F.lit(" in "), F.col("root").cast("string"))) for k in (1, 2)], F.concat(F.lit("  Unable to parse line: "), "line"))))
        .when(is_("zero distance"), F.array(F.concat(F.lit("Equivalent waypoint labels mark zero distance traveled"), end)))
    )
    told = resolved.where("status <> 'ok'").select("traveler", "line_no", F.posexplode(texts).alias("k", "text"))
    return line(told, 0, F.col("text"), c=F.col("line_no"), d=F.col("k"))


def processed(resolved: DataFrame, segments: DataFrame) -> DataFrame:
    """resolved: traveler, status; segments: traveler, m (different segments marked)."""
    n = resolved.groupBy("traveler").agg(F.count_if(F.col("status") == "ok").alias("n")).join(segments, "traveler", "left")
    return line(n, 1, F.format_string("Processed %d good lines marking %d segments traveled.", "n", F.coalesce("m", F.lit(0).cast("long"))))


def of_count(part: str, whole: str) -> Column:
    """x of y (p%)."""
    return F.concat(F.format_string("%d of %d (", part, whole), fixed(F.lit(100.0) * F.col(part) / F.col(whole), 1), F.lit("%)"))


def statistics(groups: DataFrame, driven: DataFrame, totals: DataFrame) -> list[DataFrame]:
    """Lines of mileage. groups: network.groups; totals: travel.route_totals; driven: travel.driven_roots. The last of the
    DataFrames has a row for each root that a traveler has driven, of which `logs` makes the lines.

    All lines come from sums, which are made once and checkpointed."""
    ensure_checkpoints(groups)
    active = F.when(F.col("level") == "active", F.col("length") / F.col("n_active")).otherwise(0.0)
    whole = groups.where(SHOWN).groupBy("system", "level", "region").agg(F.sum(active).alias("am"), F.sum(F.col("length") / F.col("n_shown")).alias("pm"), F.sum(F.col("length") / F.col("n_system")).alias("sm")).checkpoint()
    driven = driven.checkpoint()
    mine = driven.groupBy("traveler", "system", "level", "region").agg(*(F.sum(c).alias(c) for c in ("am", "pm", "sm")), F.count_if("first").alias("driven"), F.count_if(F.col("first") & F.col("done")).alias("done")).checkpoint()
    sums = lambda df, *by: df.groupBy(*by).agg(F.sum("am").alias("am"), F.sum("pm").alias("pm"))
    # overall and by region
    of_all = sums(whole).select(F.col("am").alias("at"), F.col("pm").alias("pt"))  # one row
    total = sums(mine, "traveler").crossJoin(F.broadcast(of_all))
    overall = [F.lit("Clinched Highway Statistics"), F.concat(F.lit("Overall in active systems: "), of_miles(F.col("am"), F.col("at"))), F.concat(F.lit("Overall in active+preview systems: "), of_miles(F.col("pm"), F.col("pt"))), F.lit("Overall by region: (each line reports active only then active+preview)")]
    out = [several(total, 2, [(0, e, v) for e, v in enumerate(overall)])]
    by_region = sums(mine, "traveler", "region").join(sums(whole, "region").select("region", F.col("am").alias("at"), F.col("pm").alias("pt")), "region")
    out.append(line(by_region, 3, F.concat("region", F.lit(": "), of_miles(F.col("am"), F.col("at")), F.lit(", "), of_miles(F.col("pm"), F.col("pt"))), b=F.col("region")))
    # systems, how many of their connected routes, and their regions where there are several
    system_regions = whole.select("system", "level", "region", F.col("sm").alias("t"))
    systems = system_regions.groupBy("system", "level").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    own_regions = mine.select("traveler", "system", "region", F.col("sm").alias("m"))
    sizes = totals.groupBy("system").agg(F.count_if("con_first").alias("of"))
    counts = mine.groupBy("traveler", "system", "level").agg(F.sum("sm").alias("m"), F.sum("driven").alias("driven"), F.sum("done").alias("done"))
    traveled = counts.join(systems.drop("level"), "system").join(sizes, "system")
    s = F.concat(F.lit("System "), "system")
    heads = [(0, 0, F.concat(s, F.lit(" ("), "level", F.lit(") overall: "), of_miles(F.col("m"), F.col("t"))))]
    heads.append((1, 0, F.when(F.col("n") > 1, F.concat(s, F.lit(" by region:")))))
    heads.append((3, 0, F.concat(s, F.lit(" by route (traveled routes only):"))))
    heads.append((5, 0, F.when(F.col("driven") > 0, F.concat(s, F.lit(" connected routes traveled: "), of_count("driven", "of"), F.lit(", clinched: "), of_count("done", "of"), F.lit(".")))))
    out.append(several(traveled, 4, heads, a=F.col("system")))
    cells = traveled.where("n > 1").select("traveler", "system").join(system_regions, "system").join(own_regions, ["traveler", "system", "region"], "left")
    out.append(line(cells, 4, F.concat(F.lit("  "), "region", F.lit(": "), of_miles(F.coalesce("m", F.lit(0.0)), F.col("t"))), a=F.col("system"), sub=2, b=F.col("region")))
    # grand summary
    is_ = lambda level: F.col("level") == level
    number = systems.agg(*(F.count_if(is_(x)).alias(f"{x}_of") for x in ("active", "preview")))  # one row
    levels = traveled.where("driven > 0").select("traveler", "level", (F.col("done") == F.col("of")).alias("all")).groupBy("traveler").agg(*(F.count_if(is_(x) & y).alias(f"{x}_{k}") for x in ("active", "preview") for k, y in (("driven", F.lit(True)), ("done", F.col("all")))))
    grand = [(0, e, F.concat(F.lit("Traveled "), of_count(f"{x}_driven", f"{x}_of"), F.lit(", Clinched "), of_count(f"{x}_done", f"{x}_of"), F.lit(f" {x} systems"))) for e, x in ((1, "active"), (2, "preview"))]
    out.append(several(levels.crossJoin(F.broadcast(number)), 5, [(0, 0, F.lit("")), *grand]))
    # connected routes and their roots
    rows = driven.where("m > 0")
    rows = line(rows, 4, F.lit(None).cast("string"), a=F.col("system"), sub=4, c=F.col("con_id"), d=F.col("root"), e=1, more=ROOT)
    return [*out, rows]


def recent_updates(listed: DataFrame, updates: DataFrame, dates: DataFrame) -> DataFrame:
    """The newest update of each listed route that is not older than the traveler's list. listed: traveler, root; updates: root, date,
    region, route, description; dates: traveler, since."""
    head = dates.select("traveler")
    rows = listed.distinct().join(updates, "root").join(dates, "traveler").where(F.col("date") >= F.col("since"))
    text = F.concat_ws(" | ", "date", "region", "route", F.col("root").cast("string"), "description")
    return several(head, 6, [(0, 0, F.lit("")), (0, 1, F.lit("Most recent updates for listed routes:"))]).unionByName(line(rows, 7, text, b=F.col("date"), c=F.col("root")))


def logs(parts: list[DataFrame]) -> DataFrame:
    """traveler, line_no (from 0), value of all logs. A row of a root tells its connected route's line before its own if it is the
    first there, and a blank line after it if it is the last and the connected route has several roots."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    of_root, several_roots = F.col("m").isNotNull(), F.col("con_roots") > 1
    head, blank = of_root & F.col("first"), of_root & F.col("last") & several_roots
    weight = F.lit(1) + F.when(head, 1).otherwise(0) + F.when(blank, 1).otherwise(0)
    ahead = Window.partitionBy("traveler").orderBy(*KEYS, "value").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum(weight).over(ahead), F.lit(0)))
    con = F.concat(F.lit("C"), F.col("c").cast("string"), F.lit(": "), of_miles(F.col("con_m"), F.col("con_miles")))
    name = F.concat(F.lit("R"), F.col("d").cast("string"))
    own = F.when(several_roots, F.concat(F.lit("  "), name, F.lit(": "), of_miles(F.col("m"), F.col("root_miles")))).otherwise(F.concat(F.lit(" ("), name, F.lit(" only)")))
    texts = F.when(of_root, F.array_compact(F.array(F.when(head, con), own, F.when(blank, F.lit(""))))).otherwise(F.array("value"))
    told = placed.select("traveler", "_before", F.posexplode(texts).alias("_k", "value"))
    return told.select("traveler", (F.col("_before") + F.col("_k")).cast("long").alias("line_no"), "value")
