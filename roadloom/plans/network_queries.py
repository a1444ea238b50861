"""Queries on segments, mileage, travel and ranks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import network, stats, travel
from ..sources import tables
from .registry import query


class Net:
    """The network of one folder; every step is a plan, made when it is first asked for, and nothing is computed here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def points(self) -> DataFrame:
        return tables.points(self.spark, self.sf_dir)

    @cached_property
    def routes(self) -> DataFrame:
        return tables.routes(self.spark, self.sf_dir)

    @cached_property
    def segments(self) -> DataFrame:
        return network.between(tables.steps(self.spark, self.sf_dir))

    @cached_property
    def named(self) -> DataFrame:
        return self.segments.join(self.routes, "root")

    @cached_property
    def shared(self) -> DataFrame:
        return network.shares(self.named)

    @cached_property
    def groups(self) -> DataFrame:
        return network.groups(self.named)

    @cached_property
    def lengths(self) -> DataFrame:
        return self.points.groupBy("root").agg(F.count("*").alias("n"))

    @cached_property
    def entries(self) -> DataFrame:
        return tables.entries(self.spark, self.sf_dir, self.lengths)

    @cached_property
    def covered(self) -> DataFrame:
        """Listed segments without their routes' columns: enough to tell which pairs are traveled."""
        return travel.covered(self.entries, self.segments)

    @cached_property
    def direct(self) -> DataFrame:
        return self.covered.join(self.routes, "root").select("traveler", *self.named.columns)

    @cached_property
    def pairs(self) -> DataFrame:
        return travel.traveled_pairs(self.covered)

    @cached_property
    def clinched(self) -> DataFrame:
        return travel.clinched(self.direct, self.named, self.pairs)

    @cached_property
    def clinched_groups(self) -> DataFrame:
        return travel.clinched_groups(self.direct, self.groups, self.pairs)

    def clinched_miles(self, *by: str, active_only: bool = False) -> DataFrame:
        """traveler, `by` columns, am and pm: clinched miles of active, and of active and preview segments."""
        groups, direct = (df.where("level = 'active'") if active_only else df for df in (self.groups, self.direct))
        return travel.clinched_sums(direct, groups, self.pairs, list(by), {"am": stats.active(), "pm": stats.shown()})


def D(c: str, digits: int = 2) -> F.Column:  # noqa: N802
    return F.round(F.sum(c), digits)


@query("a03_region_mileage", """
SELECT reg AS region, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 2) AS active_miles,
  round(sum(CASE WHEN lvl <> 'devel' THEN len / n_shown ELSE 0 END), 2) AS active_preview_miles, round(sum(len / n_all), 2) AS overall_miles
FROM shr GROUP BY reg""")
def region_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.region_mileage(Net(spark, sf_dir).groups)


@query("prj01_segments", "SELECT root, idx, round(len, 4) AS length FROM seg")
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).segments.select("root", "idx", F.round("length", 4).alias("length"))


@query("prj02_readable_names", """
SELECT root, reg || ' ' || sys || 'B' || substr(lvl, 1, 1) AS readable, sys || 'B' || substr(lvl, 1, 1) AS list_name, sys || 'B' AS no_abbrev FROM rts""")
def readable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat("system", F.lit("B"), F.substring("level", 1, 1))
    return tables.routes(spark, sf_dir).select("root", F.concat_ws(" ", "region", listed).alias("readable"), listed.alias("list_name"), F.concat("system", F.lit("B")).alias("no_abbrev"))


@query("prj03_connected_names", """
SELECT con AS con_id, min(sys) || CASE WHEN count(*) > 10 THEN ' (' || min(reg) || ')' ELSE '' END AS readable FROM rts GROUP BY con""")
def connected_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = tables.routes(spark, sf_dir).groupBy("con_id").agg(F.min("system").alias("s"), F.min("region").alias("g"), F.count("*").alias("n"))
    return per.select("con_id", F.concat("s", F.when(F.col("n") > 10, F.concat(F.lit(" ("), "g", F.lit(")"))).otherwise("")).alias("readable"))


@query("prj04_point_names", "SELECT root || '@' || label AS point, CAST(count(*) AS BIGINT) AS n FROM pts GROUP BY 1")
def point_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.points(spark, sf_dir).groupBy(F.concat_ws("@", F.col("root").cast("string"), "label").alias("point")).agg(F.count("*").alias("n"))


@query("prj05_hidden_points", "SELECT root, CAST(count(*) FILTER (starts_with(label, '+')) AS BIGINT) AS hidden, CAST(count(*) FILTER (NOT starts_with(label, '+')) AS BIGINT) AS visible FROM pts GROUP BY root")
def hidden_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.points(spark, sf_dir).groupBy("root").agg(F.count_if(F.startswith("label", F.lit("+"))).alias("hidden"), F.count_if(~F.startswith("label", F.lit("+"))).alias("visible"))


@query("prj06_levels", """
SELECT sys AS system, lvl = 'active' AS active, lvl = 'preview' AS preview, lvl <> 'devel' AS active_or_preview, lvl = 'devel' AS devel, CAST(count(*) AS BIGINT) AS routes
FROM rts GROUP BY sys, lvl""")
def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_ = lambda x: F.col("level") == x
    rows = tables.routes(spark, sf_dir).groupBy("system", "level").agg(F.count("*").alias("routes"))
    return rows.select("system", is_("active").alias("active"), is_("preview").alias("preview"), (~is_("devel")).alias("active_or_preview"), is_("devel").alias("devel"), "routes")


@query("prj07_label_keys", "SELECT upper(regexp_replace('*+'[(root % 2) + 1] || lower(label), '^[+*]+', '')) AS label_key, CAST(count(*) AS BIGINT) AS n FROM pts GROUP BY 1")
def label_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import ascii_lower, label_key

    raw = F.concat(F.when(F.col("root") % 2 == 0, "*").otherwise("+"), ascii_lower(F.col("label")))
    return tables.points(spark, sf_dir).groupBy(label_key(raw).alias("label_key")).agg(F.count("*").alias("n"))


_EDGES = """
SELECT round(alat, 1) AS alat, round(alng, 1) AS alng, round(blat, 1) AS blat, round(blng, 1) AS blng,
  string_agg(sys || '#' || root, ',' ORDER BY sys, root, idx) AS label, CAST(count(*) AS BIGINT) AS members FROM grp WHERE NOT zero AND {0} GROUP BY ALL"""


def edge_labels(shared: DataFrame) -> DataFrame:
    """Per pair of points, the names of its routes in order."""
    named = F.struct("system", "root", "idx", F.concat("system", F.lit("#"), F.col("root").cast("string")).alias("name"))
    rows = shared.where("pair IS NOT NULL").groupBy("pair").agg(F.array_sort(F.collect_list(named)).alias("m"))
    at = [F.round(F.col(f"pair.{e}.{c}"), 1).alias(f"{e}{c}") for e in "ab" for c in ("lat", "lng")]
    return rows.select(*at, F.concat_ws(",", F.col("m.name")).alias("label"), F.size("m").cast("long").alias("members"))


@query("prj08_edge_labels", _EDGES.format("lvl <> 'devel'"))
def shown_edge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_labels(Net(spark, sf_dir).segments.join(tables.routes(spark, sf_dir), "root").where("level <> 'devel'"))


@query("prj09_system_edge_labels", _EDGES.format("sys IN ('1-URGENT', '3-MEDIUM')"))
def system_edge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_labels(Net(spark, sf_dir).segments.join(tables.routes(spark, sf_dir), "root").where(F.col("system").isin("1-URGENT", "3-MEDIUM")))


@query("prj10_canonical_segments", """
SELECT root, idx, sys AS system FROM (SELECT *, row_number() OVER (PARTITION BY alat, alng, blat, blng ORDER BY sys, root, idx) AS r FROM grp WHERE NOT zero AND lvl <> 'devel') WHERE r = 1""")
def canonical_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    rows = net.segments.join(net.routes, "root").where("pair IS NOT NULL AND level <> 'devel'")
    return rows.groupBy("pair").agg(F.min(F.struct("system", "root", "idx")).alias("f")).select("f.root", "f.idx", "f.system")


@query("prj11_connected_ends", """
SELECT p.root, CASE WHEN p.root % 2 = 0 THEN last(label ORDER BY idx) ELSE first(label ORDER BY idx) END AS con_beg, CASE WHEN p.root % 2 = 0 THEN first(label ORDER BY idx) ELSE last(label ORDER BY idx) END AS con_end
FROM pts p GROUP BY p.root""")
def connected_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = tables.points(spark, sf_dir).groupBy("root").agg(F.min_by("label", "idx").alias("a"), F.max_by("label", "idx").alias("b"))
    flipped = F.col("root") % 2 == 0
    return ends.select("root", F.when(flipped, F.col("b")).otherwise(F.col("a")).alias("con_beg"), F.when(flipped, F.col("a")).otherwise(F.col("b")).alias("con_end"))


@query("prj12_graph_names", """, c AS (SELECT DISTINCT 'region' AS category, reg AS code FROM rts UNION ALL SELECT DISTINCT 'country', country FROM rts UNION ALL SELECT DISTINCT 'system', sys FROM rts)
SELECT category, format, regexp_replace(lower(code), '[^a-z0-9]+', '-', 'g') || '-' || category || CASE format WHEN 'collapsed' THEN '' ELSE '-' || format END || '.tmg' AS file, code || ' (' || category || ')' AS description FROM c, (VALUES ('simple'), ('collapsed'), ('traveled')) f(format)""")
def graph_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File name, description and category of the graph of every region, country and system in its three formats."""
    routes = tables.routes(spark, sf_dir)
    specs = [routes.select(F.lit(k).alias("category"), F.col(c).alias("code")).distinct() for k, c in (("region", "region"), ("country", "country"), ("system", "system"))]
    rows = specs[0].unionByName(specs[1]).unionByName(specs[2]).withColumn("format", F.explode(F.array(F.lit("simple"), F.lit("collapsed"), F.lit("traveled"))))
    tag = F.regexp_replace(F.lower("code"), "[^a-z0-9]+", "-")
    return rows.select("category", "format", F.concat(tag, F.lit("-"), "category", F.when(F.col("format") == "collapsed", "").otherwise(F.concat(F.lit("-"), "format")), F.lit(".tmg")).alias("file"), F.concat("code", F.lit(" ("), "category", F.lit(")")).alias("description"))


@query("j01_code_joins", "SELECT c_custkey, n_name AS region, r_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey", base=False)
def code_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = tables.read(spark, sf_dir, "nation"), tables.read(spark, sf_dir, "region")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return tables.read(spark, sf_dir, "customer").join(named, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.col("n_name").alias("region"), F.col("r_name").alias("country"))


@query("j04_colocation", "SELECT round(lat, 1) AS lat, round(lng, 1) AS lng, CAST(count(*) AS BIGINT) AS n_points FROM pts GROUP BY lat, lng")
def colocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.colocated(tables.points(spark, sf_dir)).select(F.round("lat", 1).alias("lat"), F.round("lng", 1).alias("lng"), "n_points")


@query("j05_concurrency", "SELECT root, idx, CAST(n_all AS BIGINT) AS members FROM shr WHERE NOT zero AND n_all > 1")
def concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).shared.where("pair IS NOT NULL AND n_all > 1").select("root", "idx", F.col("n_all").alias("members"))


@query("j06_entry_segments", "SELECT trav AS traveler, root, idx FROM dir")
def entry_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).direct.select("traveler", "root", "idx").distinct()


@query("j07_propagation", "SELECT trav AS traveler, root, idx FROM prop")
def propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).clinched.select("traveler", "root", "idx")


@query("a01_concurrency_counts", "SELECT root, idx, CAST(n_all AS BIGINT) AS n_all, CAST(n_active AS BIGINT) AS n_active, CAST(n_shown AS BIGINT) AS n_shown, CAST(n_system AS BIGINT) AS n_system FROM shr")
def concurrency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).shared.select("root", "idx", "n_all", "n_active", "n_shown", "n_system")


@query("a02_route_mileage", "SELECT root, round(sum(len), 2) AS miles FROM seg GROUP BY root")
def route_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).segments.groupBy("root").agg(D("length").alias("miles"))


@query("a04_region_preview_mileage", "SELECT reg AS region, round(sum(len / n_shown), 2) AS miles FROM shr WHERE lvl <> 'devel' GROUP BY reg")
def region_preview_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).groups.where("level <> 'devel'").groupBy("region").agg(stats.miles(stats.shown()).alias("miles"))


@query("a05_region_overall_mileage", "SELECT reg AS region, round(sum(len / n_all), 2) AS miles FROM shr GROUP BY reg")
def region_overall_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).groups.groupBy("region").agg(stats.miles(F.col("length") / F.col("n_all")).alias("miles"))


@query("a06_system_region_mileage", "SELECT sys AS system, reg AS region, round(sum(len / n_system), 2) AS miles FROM shr GROUP BY sys, reg")
def system_region_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Net(spark, sf_dir).groups.groupBy("system", "region").agg(stats.miles(F.col("length") / F.col("n_system")).alias("miles"))


@query("a07_traveler_region_mileage", """
SELECT trav AS traveler, reg AS region, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 2) AS active_miles, round(sum(len / n_shown), 2) AS active_preview_miles
FROM cli WHERE lvl <> 'devel' GROUP BY ALL""")
def traveler_region_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Net(spark, sf_dir).clinched_groups
    return rows.groupBy("traveler", "region").agg(stats.miles(stats.active()).alias("active_miles"), stats.miles(stats.shown()).alias("active_preview_miles"))


@query("a08_traveler_system_mileage", "SELECT trav AS traveler, sys AS system, reg AS region, round(sum(len / n_system), 2) AS miles FROM cli WHERE lvl <> 'devel' GROUP BY ALL")
def traveler_system_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Net(spark, sf_dir).clinched_groups
    return rows.groupBy("traveler", "system", "region").agg(stats.miles(F.col("length") / F.col("n_system")).alias("miles"))


@query("a09_totals", """
SELECT 'system' AS kind, sys AS name, round(sum(len / n_system), 1) AS miles FROM shr GROUP BY sys
UNION ALL SELECT 'all', 'active', round(sum(len / n_active), 1) FROM shr WHERE lvl = 'active'
UNION ALL SELECT 'all', 'overall', round(sum(len / n_all), 1) FROM shr
UNION ALL SELECT 'traveler', CAST(trav AS VARCHAR), round(sum(len / n_active), 1) FROM cli WHERE lvl = 'active' GROUP BY trav""")
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    part = lambda kind, name, rows, value: rows.groupBy(F.lit(kind).alias("kind"), name.alias("name")).agg(stats.miles(value, 1).alias("miles"))
    length = F.col("length")
    return (
        part("system", F.col("system"), net.groups, length / F.col("n_system"))
        .unionByName(part("all", F.lit("active"), net.groups.where("level = 'active'"), length / F.col("n_active")))
        .unionByName(part("all", F.lit("overall"), net.groups, length / F.col("n_all")))
        .unionByName(part("traveler", F.col("traveler").cast("string"), net.clinched_groups.where("level = 'active'"), length / F.col("n_active")))
    )


@query("a10_connected_mileage", "SELECT con AS con_id, round(sum(len), 2) AS miles FROM grp GROUP BY con")
def connected_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    per = net.segments.groupBy("root").agg(F.sum("length").alias("m"))
    return per.join(net.routes.select("root", "con_id"), "root").groupBy("con_id").agg(D("m").alias("miles"))


_ROUTES = """
SELECT trav AS traveler, c.{0} AS {1}, round(sum(len), 2) AS miles, count(*) = any_value(n) AS clinched
FROM cli c JOIN (SELECT {0}, count(*) AS n FROM grp GROUP BY {0}) t ON c.{0} = t.{0} GROUP BY trav, c.{0}"""


def clinched_by(net: Net, key: str) -> DataFrame:
    whole = net.segments.join(net.routes.select("root", "con_id"), "root").groupBy(key).agg(F.count("*").alias("n"))
    mine = net.clinched.groupBy("traveler", key).agg(D("length").alias("miles"), F.count("*").alias("own"))
    return mine.join(whole, key).select("traveler", key, "miles", (F.col("own") == F.col("n")).alias("clinched"))


@query("a11_traveler_routes", _ROUTES.format("root", "root"))
def traveler_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clinched_by(Net(spark, sf_dir), "root")


@query("a12_traveler_connected", _ROUTES.format("con", "con_id"))
def traveler_connected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clinched_by(Net(spark, sf_dir), "con_id")


_A13 = """, tot AS (SELECT sys, con, count(*) AS n FROM grp GROUP BY ALL),
own AS (SELECT trav, sys, con, count(*) AS m FROM cli WHERE lvl <> 'devel' GROUP BY ALL),
per AS (SELECT trav, own.sys, count(*) AS driven, count(*) FILTER (m = n) AS done FROM own JOIN tot ON own.sys = tot.sys AND own.con = tot.con GROUP BY ALL),
sz AS (SELECT sys, count(*) AS n_con FROM tot GROUP BY sys)
"""


@query("a13_traveler_system_routes", _A13 + """
SELECT trav AS traveler, per.sys AS system, CAST(driven AS BIGINT) AS driven, CAST(done AS BIGINT) AS clinched, round(100.0 * driven / n_con, 2) AS driven_pct, round(100.0 * done / n_con, 2) AS clinched_pct
FROM per JOIN sz ON per.sys = sz.sys""")
def traveler_system_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _system_routes(Net(spark, sf_dir))


def _system_routes(net: Net) -> DataFrame:
    whole = net.segments.join(net.routes, "root").groupBy("system", "con_id").agg(F.count("*").alias("n"))
    own = net.clinched.where("level <> 'devel'").groupBy("traveler", "system", "con_id").agg(F.count("*").alias("m"))
    per = own.join(whole, ["system", "con_id"]).groupBy("traveler", "system").agg(F.count("*").alias("driven"), F.count_if(F.col("m") == F.col("n")).alias("clinched"))
    sizes = whole.groupBy("system").agg(F.count("*").alias("n_con"))
    pct = lambda c: F.round(F.lit(100.0) * F.col(c) / F.col("n_con"), 2).alias(f"{c}_pct")
    return per.join(sizes, "system").select("traveler", "system", "driven", "clinched", pct("driven"), pct("clinched"))


@query("a14_traveler_summary", _A13 + """
SELECT trav AS traveler, CAST(count(*) FILTER (per.sys IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS active_traveled, CAST(count(*) FILTER (per.sys IN ('1-URGENT', '2-HIGH') AND done = n_con) AS BIGINT) AS active_clinched,
 CAST(count(*) FILTER (per.sys = '3-MEDIUM') AS BIGINT) AS preview_traveled, CAST(count(*) FILTER (per.sys = '3-MEDIUM' AND done = n_con) AS BIGINT) AS preview_clinched
FROM per JOIN sz ON per.sys = sz.sys GROUP BY trav""")
def traveler_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _system_routes(Net(spark, sf_dir))
    level, whole = tables.level_of(F.col("system")), F.col("clinched_pct") == 100.0
    return rows.groupBy("traveler").agg(*(F.count_if((level == lv) & x).alias(f"{lv}_{n}") for lv in ("active", "preview") for n, x in (("traveled", F.lit(True)), ("clinched", whole))))


@query("a15_rank_totals", """, m AS (SELECT trav, round(sum(len / n_active), 2) AS miles FROM cli WHERE lvl = 'active' GROUP BY trav), t AS (SELECT sum(len / n_active) AS total FROM shr WHERE lvl = 'active')
SELECT trav AS traveler, miles, CASE WHEN total = 0 THEN 0 ELSE round(100 * miles / total, 2) END AS pct FROM m, t""")
def rank_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    own = net.clinched_miles(active_only=True).select("traveler", F.round("am", 2).alias("miles"))
    total = net.groups.where("level = 'active'").agg(F.sum(stats.active()).alias("total"))  # one row
    return own.crossJoin(F.broadcast(total)).select("traveler", "miles", F.when(F.col("total") == 0, 0.0).otherwise(F.round(100 * F.col("miles") / F.col("total"), 2)).alias("pct"))


@query("a16_colocation_histogram", "SELECT n_points, CAST(count(*) AS BIGINT) AS coordinates FROM (SELECT CAST(count(*) AS BIGINT) AS n_points FROM pts GROUP BY lat, lng) GROUP BY 1")
def colocation_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.colocated(tables.points(spark, sf_dir)).groupBy("n_points").agg(F.count("*").alias("coordinates"))


@query("a18_entity_counts", """
SELECT 'systems' AS entity, CAST(count(DISTINCT sys) AS BIGINT) AS n FROM rts UNION ALL SELECT 'routes', count(*) FROM rts
UNION ALL SELECT 'points', count(*) FROM pts UNION ALL SELECT 'segments', count(*) FROM seg UNION ALL SELECT 'locations', count(*) FROM (SELECT DISTINCT lat, lng FROM pts)""")
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    of = lambda name, rows: rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n")
    parts = [of("systems", net.routes.select("system").distinct()), of("routes", net.routes), of("points", net.points), of("segments", net.segments), of("locations", net.points.select("lat", "lng").distinct())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a23_distinct_sets", """
SELECT 'travelers' AS kind, reg AS name, CAST(count(DISTINCT trav) AS BIGINT) AS n FROM cli GROUP BY reg UNION ALL SELECT 'regions', sys, count(DISTINCT reg) FROM rts GROUP BY sys""")
def distinct_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    a = net.clinched.groupBy(F.col("region").alias("name")).agg(F.countDistinct("traveler").alias("n"))
    b = net.routes.groupBy(F.col("system").alias("name")).agg(F.countDistinct("region").alias("n"))
    return a.select(F.lit("travelers").alias("kind"), "name", "n").unionByName(b.select(F.lit("regions").alias("kind"), "name", "n"))


@query("w01_mileage_ranks", """, m AS (SELECT trav, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 2) AS am, round(sum(len / n_shown), 2) AS pm FROM cli WHERE lvl <> 'devel' GROUP BY trav),
i AS (SELECT *, trav % 5 <> 0 AS ok FROM m)
SELECT trav AS traveler, CASE WHEN ok THEN CAST(rank() OVER (PARTITION BY ok ORDER BY am DESC) AS INTEGER) ELSE -1 END AS active_rank, CASE WHEN ok THEN CAST(rank() OVER (PARTITION BY ok ORDER BY pm DESC) AS INTEGER) ELSE -1 END AS preview_rank FROM i""")
def mileage_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth traveler does not want to be ranked."""
    rows = Net(spark, sf_dir).clinched_miles().select("traveler", F.round("am", 2).alias("am"), F.round("pm", 2).alias("pm"))
    allowed = F.col("traveler") % 5 != 0
    return stats.ranked(rows, {"am": "active_rank", "pm": "preview_rank"}, allowed).select("traveler", "active_rank", "preview_rank")


@query("w02_route_ranks", """, x AS (SELECT trav, c.con, any_value(lvl) AS lvl, count(*) AS m FROM cli c WHERE lvl = 'active' GROUP BY trav, c.con),
t AS (SELECT con, count(*) AS n FROM grp WHERE lvl = 'active' GROUP BY con), p AS (SELECT trav, count(*) AS driven, count(*) FILTER (m = n) AS done FROM x JOIN t USING (con) GROUP BY trav)
SELECT trav AS traveler, CAST(driven AS BIGINT) AS driven, CAST(done AS BIGINT) AS clinched, CAST(rank() OVER (ORDER BY driven DESC) AS INTEGER) AS driven_rank, CAST(rank() OVER (ORDER BY done DESC) AS INTEGER) AS clinched_rank FROM p""")
def route_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    own = net.clinched.where("level = 'active'").groupBy("traveler", "con_id").agg(F.count("*").alias("m"))
    whole = net.segments.join(net.routes, "root").where("level = 'active'").groupBy("con_id").agg(F.count("*").alias("n"))
    per = own.join(whole, "con_id").groupBy("traveler").agg(F.count("*").alias("driven"), F.count_if(F.col("m") == F.col("n")).alias("clinched"))
    return stats.ranked(per, {"driven": "driven_rank", "clinched": "clinched_rank"}, F.lit(True)).select("traveler", "driven", "clinched", "driven_rank", "clinched_rank")


@query("w03_visible_runs", """, r AS (SELECT p.root, p.idx, p.hid, p.label, s.len, sum(CASE WHEN hid THEN 0 ELSE 1 END) OVER (PARTITION BY p.root ORDER BY p.idx) AS island FROM pts p LEFT JOIN seg s ON p.root = s.root AND p.idx = s.idx)
SELECT root, CAST(island AS BIGINT) AS island, round(sum(len), 2) AS miles FROM r WHERE len IS NOT NULL GROUP BY ALL""")
def visible_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Miles from each visible point of a route to the next one."""
    net = Net(spark, sf_dir)
    along = Window.partitionBy("root").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = net.points.withColumn("island", F.sum(F.when(F.col("is_hidden"), 0).otherwise(1)).over(along)).select("root", "idx", "island")
    return net.segments.join(marked, ["root", "idx"]).groupBy("root", "island").agg(D("length").alias("miles"))


@query("w06_neighbour_points", """
SELECT root, idx, lag(label) OVER w AS before_label, lead(label) OVER w AS after_label FROM pts WINDOW w AS (PARTITION BY root ORDER BY idx)""")
def neighbour_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    along = Window.partitionBy("root").orderBy("idx")
    return tables.points(spark, sf_dir).select("root", "idx", F.lag("label").over(along).alias("before_label"), F.lead("label").over(along).alias("after_label"))


@query("w07_segment_ids", "SELECT root, idx, CAST(row_number() OVER (ORDER BY root, idx) - 1 AS BIGINT) AS segment_id FROM seg")
def segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers in (root, idx) order: per-partition counts of a range partitioning give the offsets, so no task sees all rows."""
    from ..operators.numbering import dense

    return dense(Net(spark, sf_dir).segments.select("root", "idx"), ["root", "idx"], "segment_id")


@query("w08_root_order", "SELECT con AS con_id, root, CAST(row_number() OVER (PARTITION BY con ORDER BY root) - 1 AS INTEGER) AS root_order FROM rts")
def root_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = tables.routes(spark, sf_dir).groupBy("con_id").agg(F.array_sort(F.collect_list("root")).alias("roots"))
    return lists.select("con_id", F.posexplode("roots").alias("root_order", "root"))


@query("w09_front_points", "SELECT round(lat, 1) AS lat, round(lng, 1) AS lng, min(root || '@' || label) AS front FROM pts GROUP BY lat, lng")
def front_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = tables.points(spark, sf_dir).withColumn("name", F.concat_ws("@", F.col("root").cast("string"), "label"))
    return named.groupBy("lat", "lng").agg(F.min("name").alias("front")).select(F.round("lat", 1).alias("lat"), F.round("lng", 1).alias("lng"), "front")


_PIVOT = """, m AS (SELECT trav, reg, sum(len / n_active) AS v FROM cli WHERE lvl = 'active' GROUP BY ALL), c AS (SELECT CAST(trav AS VARCHAR) AS traveler, reg, v FROM m UNION ALL SELECT 'TOTAL', reg, sum(len / n_active) FROM shr WHERE lvl = 'active' GROUP BY reg)
SELECT traveler, round(sum(v), 1) AS total, {0} FROM c GROUP BY traveler"""
NATIONS = [f"NATION_{k}" for k in range(25)]


@query("snk03_region_pivot", _PIVOT.format(", ".join(f"""round(coalesce(sum(v) FILTER (reg = '{n}'), 0), 1) AS "{n}\"""" for n in NATIONS)))
def region_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traveler x region miles with a Total column and a TOTAL row; columns are the fixed list of regions."""
    net = Net(spark, sf_dir)
    own = net.clinched_groups.where("level = 'active'").groupBy(F.col("traveler").cast("string").alias("traveler"), "region").agg(F.sum(stats.active()).alias("v"))
    whole = net.groups.where("level = 'active'").groupBy(F.lit("TOTAL").alias("traveler"), "region").agg(F.sum(stats.active()).alias("v"))
    wide = own.unionByName(whole).groupBy("traveler").pivot("region", NATIONS).agg(F.sum("v"))
    total = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in NATIONS), F.lit(0.0))
    return wide.select("traveler", F.round(total, 1).alias("total"), *(F.round(F.coalesce(F.col(n), F.lit(0.0)), 1).alias(n) for n in NATIONS))
