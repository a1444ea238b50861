"""Queries for the native parsers and list resolution, over lines built from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T  # noqa: N812
from ..operators import connected, lists, travel
from ..sources import native, tables
from .check_queries import WALK
from .registry import query


def _part(spark: SparkSession, sf_dir: str, line: str, start: int = 1) -> DataFrame:
    """A line of text for each part: an SQL expression over its columns."""
    rows = tables.read(spark, sf_dir, "part").selectExpr(f"CAST(p_partkey + {start} AS INT) AS line_no", f"{line} AS value")
    return rows.withColumn("path", F.lit("part"))


@query("src01_code_names", "SELECT 'C' || (p_partkey % 90) AS code, p_name AS name FROM part WHERE p_partkey % 7 <> 0 AND strlen(p_name) <= 15 AND p_partkey % 11 <> 0", base=False)
def code_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh line has a field too many, every eleventh is blank."""
    line = "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE 'C' || (p_partkey % 90) || ';' || p_name || CASE WHEN p_partkey % 7 = 0 THEN ';' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN '\\r' ELSE '' END END"
    return native.code_names(_part(spark, sf_dir, line))[0]


@query("src02_regions", """SELECT 'R' || p_partkey AS code, p_type AS name, CASE WHEN p_size <= 30 THEN 'C' || p_size ELSE 'error' END AS country, CASE WHEN p_size % 7 < 5 THEN 'K' || (p_size % 7) ELSE 'error' END AS continent, p_brand AS region_type FROM part""", base=False)
def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = spark.range(0, 31).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("code"))
    continents = spark.range(0, 5).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("code"))
    line = "'R' || p_partkey || ';' || p_type || ';C' || p_size || ';K' || (p_size % 7) || ';' || p_brand"
    return native.regions(_part(spark, sf_dir, line), countries, continents)[0]


@query("src03_systems", """SELECT 's' || (p_partkey % 500) AS system, 'USA' AS country, p_name AS full_name, p_brand AS color, p_size % 6 AS tier, level FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'preview' WHEN 2 THEN 'devel' ELSE 'odd' END AS level, row_number() OVER (PARTITION BY p_partkey % 500 ORDER BY p_partkey) AS turn FROM part WHERE p_partkey % 13 <> 0)
WHERE turn = 1 AND p_size % 6 >= 1 AND level <> 'odd' AND p_partkey % 9 <> 0""", base=False)
def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth name has double quotes, every thirteenth line is a comment."""
    level = "CASE p_partkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'preview' WHEN 2 THEN 'devel' ELSE 'odd' END"
    line = f"CASE WHEN p_partkey % 13 = 0 THEN '#' ELSE '' END || 's' || (p_partkey % 500) || ';USA;' || p_name || CASE WHEN p_partkey % 9 = 0 THEN '\"' ELSE '' END || ';' || p_brand || ';' || (p_size % 6) || ';' || {level}"
    return native.systems(_part(spark, sf_dir, line))[0].select("system", "country", "full_name", "color", "tier", "level")


@query("src04_routes", """SELECT lower(p_brand || '.' || p_partkey) AS root, 'sys' AS system, p_type AS region, 'R' || p_size AS route, upper(p_name) AS alts, CAST(2 AS INTEGER) AS n_alts FROM part WHERE p_partkey % 17 <> 0""", base=False)
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventeenth abbrev is too long."""
    line = "'sys;' || p_type || ';R' || p_size || ';Bus;' || CASE WHEN p_partkey % 17 = 0 THEN 'Long' ELSE 'Abc' END || ';Town;' || p_brand || '.' || p_partkey || ';' || p_name || ',' || p_name"
    good = native.routes(_part(spark, sf_dir, line))[0]
    return good.select("root", "system", "region", "route", F.col("alt_route_names")[0].alias("alts"), F.size("alt_route_names").alias("n_alts"))


@query("src05_connected_routes", """SELECT 'r' || p_partkey AS con_id, 'r' || (p_partkey + k) AS root, CAST(k AS INTEGER) AS root_order FROM part, (SELECT unnest([0, 1, 2]) AS k) WHERE p_partkey % 3 = 0 AND (p_partkey + k) IN (SELECT p_partkey FROM part)""", base=False)
def connected_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = "'sys;R' || p_size || ';;Group;R' || p_partkey || ',R' || (p_partkey + 1) || ',R' || (p_partkey + 2)"
    known = tables.read(spark, sf_dir, "part").selectExpr("'r' || p_partkey AS root", "'sys' AS system")
    rows = _part(spark, sf_dir, line).where((F.col("line_no") - 1) % 3 == 0)
    return native.connected(rows, known)[0].select("con_id", "root", "root_order")


@query("src06_route_files", """ SELECT regexp_extract(label, '[0-9]+$') AS root, CAST(sum(length(label || ' http://www.openstreetmap.org/?lat=' || printf('%.6f', lat) || '&lon=' || printf('%.6f', lng)) + 1) AS INTEGER) AS n_chars FROM pts GROUP BY 1""")
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points, a file for each supplier here, in one folder of the session, read back by the crawl."""
    from ..sinks import write_waypoint_files

    points = tables.points(spark, sf_dir).select(F.regexp_extract("label", "[0-9]+$", 0).alias("root"), F.col("root").alias("idx"), "label", "lat", "lng")
    folder = write_waypoint_files(points)
    return native.route_files(spark, folder).select("root", F.length("value").alias("n_chars"))


_WPT = "'  ' || p_brand || ' +X' || p_size || '\\t\\r\\n\\r\\n \\n' || p_name || '\\n\\n'"


@query("src07_waypoint_lines", "SELECT CAST(p_partkey AS VARCHAR) AS root, CAST(0 AS INTEGER) AS idx, p_brand || ' +X' || p_size AS line FROM part UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, p_name FROM part", base=False)
def waypoint_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.read(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS root", f"{_WPT} AS value")
    return native.waypoint_lines(files)


@query("src08_waypoints", """SELECT CAST(p_partkey AS VARCHAR) AS root, p_brand AS label, CASE WHEN p_partkey % 3 = 0 THEN 'alt' || p_size ELSE '' END AS alts, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) + 0.25 END AS lat, CAST(-p_partkey AS DOUBLE) / 2 - 0.5 AS lng FROM part""", base=False)
def waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = "'-' || CAST(FLOOR((p_partkey + 1) / 2) AS BIGINT) || CASE WHEN p_partkey % 2 = 0 THEN '.5' ELSE '.0' END"
    line = f"p_brand || CASE WHEN p_partkey % 3 = 0 THEN '  alt' || p_size ELSE '' END || ' http://x/?lat=' || CASE WHEN p_partkey % 5 = 0 THEN '1e' ELSE '' END || p_size || '.25&lon=' || {half}"
    rows = tables.read(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS root", "0 AS idx", f"{line} AS line")
    return native.waypoints(rows).select("root", "label", F.concat_ws(",", "alt_labels").alias("alts"), "lat", "lng")


@query("src09_travelers", "SELECT DISTINCT 'u' || user_id AS traveler FROM events", base=False)
def travelers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tables.read(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("traveler")).distinct()
    return names.orderBy("traveler")


@query("src10_list_lines", """SELECT CAST(user_id AS VARCHAR) AS traveler, CAST(event_id AS BIGINT) AS line_no, event_type || '|' || CASE WHEN event_id % 3 = 0 THEN 'r1' WHEN event_id % 3 = 1 THEN 'r1|a|b' ELSE 'r1|a|b|x|y' END AS fields FROM events WHERE event_id % 7 <> 0""", base=False)
def list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each event here: a comment line or fields of which some follow a #."""
    line = "CASE WHEN event_id % 7 = 0 THEN '# ' || event_type ELSE event_type || ' \\t r1 ' || CASE event_id % 3 WHEN 0 THEN '#note a b' WHEN 1 THEN 'a b' ELSE 'a b x y #z' END END"
    files = tables.read(spark, sf_dir, "events").selectExpr("CAST(event_id AS STRING) AS traveler", "user_id", f"'﻿' || {line} || '\\r\\n  \\n' AS value")
    got = native.list_lines(files).join(files.select("traveler", "user_id"), "traveler")
    return got.select(F.col("user_id").cast("string").alias("traveler"), F.col("traveler").cast("long").alias("line_no"), F.concat_ws("|", "fields").alias("fields"))


@query("src11_list_info", """SELECT 'u' || p_partkey AS traveler, CASE WHEN p_size % 3 = 0 THEN 'none' ELSE p_name END AS description, CASE WHEN p_size % 2 = 0 THEN '1' ELSE '0' END AS includeInRanks FROM part""", base=False)
def list_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 0 and 1 are the header and the defaults; every name also comes a second time, which is rejected."""
    line = "'u' || p_partkey || ';' || CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END || ';' || CASE WHEN p_size % 2 = 0 THEN '' ELSE '0' END"
    head = spark.createDataFrame([(0, "listname;description;includeInRanks", "p"), (1, ";none;1", "p")], "line_no int, value string, path string")
    own = _part(spark, sf_dir, line, 2)
    return native.list_info(head.unionByName(own).unionByName(_part(spark, sf_dir, "'u' || p_partkey || ';again;9'", 1_000_000_000)))


@query("src12_updates", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'reg' || o_custkey % 9 AS region, 'r' || o_orderkey % 100 AS root FROM orders WHERE o_orderkey % 6 <> 0""", base=False)
def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth date is written with slashes."""
    day = "CASE WHEN o_orderkey % 6 = 0 THEN date_format(o_orderdate, 'yyyy/MM/dd') ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
    rows = tables.read(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey + 1 AS INT) AS line_no", f"{day} || ';reg' || (o_custkey % 9) || ';Route;r' || (o_orderkey % 100) || ';' || o_orderpriority AS value")
    return native.updates(rows)[0].select("date", "region", "root")


@query("src13_false_positives", """SELECT 'r' || p_partkey AS root, p_brand AS label1, CASE WHEN p_size % 4 = 1 THEN 'LONG_SEGMENT' WHEN p_size % 4 = 2 THEN 'SHARP_ANGLE' ELSE 'LACKS_GENERIC' END AS code FROM part WHERE p_size % 4 <> 0""", base=False)
def false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = "CASE p_size % 4 WHEN 0 THEN 'BAD_ANGLE' WHEN 1 THEN 'LONG_SEGMENT' WHEN 2 THEN 'SHARP_ANGLE' ELSE 'LACKS_GENERIC' END"
    return native.false_positives(_part(spark, sf_dir, f"'r' || p_partkey || ';' || p_brand || ';;;' || {code} || ';' || p_size"))[0].select("root", "label1", "code")


@query("src14_near_miss_marks", "SELECT DISTINCT p_brand || ' 1 2 ' || p_type AS line FROM part", base=False)
def near_miss_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = "p_brand || ' 1 2 ' || p_type || CASE p_partkey % 3 WHEN 0 THEN ' [LOOKS INTENTIONAL]' WHEN 1 THEN ' [SOME LOOK INTENTIONAL]' ELSE '' END"
    return native.near_miss_marks(_part(spark, sf_dir, line))


@query("src15_graph_specs", """SELECT 'area' AS category, 'a' || p_partkey || (p_size % 3 * 10) || '-area' AS graph, p_name || ' (' || (p_size % 3 * 10) || ' mi radius)' AS description, '' AS regions, '' AS systems, p_size + 0.5::DOUBLE AS lat, -p_size::DOUBLE AS lng, (p_size % 3 * 10)::DOUBLE AS radius FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT 'multiregion', 'm' || p_partkey, p_name, 'NATION_1,NATION_' || p_size, '', NULL, NULL, NULL FROM part UNION ALL SELECT 'multisystem', 's' || p_partkey, p_name, '', '1-URGENT,2-HIGH', NULL, NULL, NULL FROM part
UNION ALL SELECT 'system', p_brand || '-system', p_brand, '', p_brand, NULL, NULL, NULL FROM part
UNION ALL SELECT 'fullcustom', 'f' || p_partkey, p_name, 'NATION_1', '2-HIGH', 1.5, 2.5, 25 FROM part WHERE p_size % 2 = 0 AND p_size % 3 <> 0""", base=False)
def graph_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all five kinds, parsed into one schema; areas without a radius and customs with half a circle are refused."""
    forms = {
        "area": "p_name || ';a' || p_partkey || ';' || p_size || '.5;-' || p_size || ';' || (p_size % 3 * 10)",
        "multiregion": "p_name || ';m' || p_partkey || ';;NATION_1,NATION_' || p_size",
        "multisystem": "p_name || ';s' || p_partkey || ';1-URGENT,2-HIGH'",
        "system": "p_brand",
        "fullcustom": "p_name || ';f' || p_partkey || CASE WHEN p_size % 2 = 0 THEN ';1.5;2.5;' ELSE ';1.5;;' END || CASE WHEN p_size % 3 = 0 THEN '' ELSE '25' END || ';NATION_1;2-HIGH'",
    }
    out = None
    for kind, line in forms.items():
        good = native.graph_specs(_part(spark, sf_dir, line), kind)[0]
        out = good if out is None else out.unionByName(good)
    return out.select("category", "graph", "description", F.array_join("regions", ",").alias("regions"), F.array_join("systems", ",").alias("systems"), "lat", "lng", "radius")


@query("src17_update_dates", "SELECT CAST(event_id AS VARCHAR) AS traveler, strftime(ts, '%Y-%m-%d') AS date FROM events", base=False)
def update_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tables.read(spark, sf_dir, "events").selectExpr("CAST(event_id AS STRING) AS traveler", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' +0000\\nmore' AS value")
    return native.update_dates(files)


# --- list resolution: routes are parts, with three labelled points each; lines come from events
_TL = """WITH rt AS (SELECT p_partkey AS root, 'REG' || (p_partkey % 3) AS reg, 'R' || p_partkey AS ln, CASE WHEN p_partkey % 4 = 0 THEN ['Old R' || p_partkey] ELSE ['A' || p_partkey] END AS alts, CASE WHEN p_partkey % 5 = 0 THEN 'devel' ELSE 'active' END AS lvl FROM part),
nm0 AS (SELECT root, 0 AS pos, upper(reg || ' ' || ln) AS name FROM rt UNION ALL SELECT root, 1, upper(CASE WHEN contains(alts[1], ' ') THEN alts[1] ELSE reg || ' ' || alts[1] END) FROM rt),
nm AS (SELECT name, root, pos > 0 AS deprecated FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos, root) AS t FROM nm0) WHERE t = 1),
lb0 AS (SELECT root, k AS idx, 'P' || k AS label FROM rt, (SELECT unnest(range(6)) AS k) UNION ALL SELECT root, 6, 'p2' FROM rt WHERE root % 7 = 0 UNION ALL SELECT root, k, 'Q' || k FROM rt, (SELECT unnest(range(6)) AS k) WHERE root % 3 = 0),
lb AS (SELECT root, upper(label) AS key, CAST(min(idx) AS INTEGER) AS idx, count(*) > 1 AS dup FROM lb0 GROUP BY ALL),
ln4 AS (SELECT user_id AS trav, event_id AS line_no, upper('REG' || (p % 3) || ' ' || CASE WHEN event_id % 6 = 0 THEN 'A' ELSE 'R' END || p) AS name, 'P' || (k % 7) AS k1, CASE WHEN event_id % 4 = 0 THEN 'Q' ELSE 'P' END || (k % 5) AS k2 FROM (SELECT *, event_id % (SELECT count(*) + 50 FROM part) AS p, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
st AS (SELECT trav, line_no, ln4.name, k1, k2, n.root, coalesce(n.deprecated, FALSE) AS deprecated, a.idx AS i1, b.idx AS i2, CASE WHEN n.root IS NULL THEN 'unknown route' WHEN lvl = 'devel' THEN 'devel' WHEN a.idx IS NULL AND b.idx IS NULL THEN 'both labels missing' WHEN a.idx IS NULL OR b.idx IS NULL THEN 'label missing' WHEN a.dup OR b.dup THEN 'duplicate label' WHEN a.idx = b.idx THEN 'zero distance' ELSE 'ok' END AS status
 FROM ln4 LEFT JOIN nm n USING (name) LEFT JOIN rt ON rt.root = n.root LEFT JOIN lb a ON a.root = n.root AND a.key = k1 LEFT JOIN lb b ON b.root = n.root AND b.key = k2) """


class Lists:
    def __init__(self, spark: SparkSession, sf_dir: str):
        part = tables.read(spark, sf_dir, "part")
        self.routes = part.selectExpr("p_partkey AS root", "'REG' || (p_partkey % 3) AS region", "'R' || p_partkey AS list_name", "CASE WHEN p_partkey % 4 = 0 THEN array('Old R' || p_partkey) ELSE array('A' || p_partkey) END AS alt_route_names", "p_partkey AS route_order", "'S' || p_partkey % 6 AS system", "CASE WHEN p_partkey % 5 = 0 THEN 'devel' ELSE 'active' END AS level")
        own = self.routes.select("root", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("idx")).selectExpr("root", "idx", "0 AS pos", "'P' || idx AS label")
        twice = self.routes.where("root % 7 = 0").selectExpr("root", "6 AS idx", "0 AS pos", "'p2' AS label")
        other = own.where("root % 3 = 0").selectExpr("root", "idx", "1 AS pos", "'Q' || idx AS label")
        self.all_labels = own.unionByName(twice).unionByName(other)
        self.labels = lists.point_labels(self.all_labels)
        self.names = lists.route_names(self.routes)
        # each part has a point for each of its labels, and segments between them
        self.lengths = self.routes.select("root", F.when(F.col("root") % 7 == 0, 7).otherwise(6).alias("n"))
        self.segments = lists.shuffled(self.lengths.select("root", F.explode(F.sequence(F.lit(0), F.col("n") - 2)).alias("idx")))
        n = part.count() + 50
        events = tables.read(spark, sf_dir, "events").selectExpr("user_id AS traveler", "event_id AS line_no", f"event_id % {n} AS p", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")
        self.lines = events.selectExpr("traveler", "line_no", "array('reg' || (p % 3), CASE WHEN line_no % 6 = 0 THEN 'a' ELSE 'r' END || p, '*P' || (k % 7), CASE WHEN line_no % 4 = 0 THEN 'q' ELSE 'p' END || (k % 5)) AS fields")
        self.resolved = lists.resolve_chopped(self.lines, self.names, self.labels, self.routes)
        # connected routes: three parts each; lines of six fields
        self.connected = self.routes.selectExpr("CAST(root - root % 3 AS BIGINT) AS con_id", "root", "CAST(root % 3 AS INT) AS root_order", "root % 4 = 1 AS is_reversed")
        self.six = events.selectExpr("traveler", "line_no", "array('reg' || (p % 3), 'r' || p, 'P' || (k % 7), 'reg' || ((p + k % 4 - 1) % 3), 'r' || (p + k % 4 - 1), 'p' || (k % 5)) AS fields")
        ends = self.routes.selectExpr("root", "named_struct('lat', CAST(root * 5 % 4 AS DOUBLE), 'lng', 0D) AS a", "named_struct('lat', CAST((root * 7 + 1) % 4 AS DOUBLE), 'lng', 0D) AS b")
        self.ends = self.connected.join(lists.shuffled(ends), "root").join(lists.shuffled(self.lengths), "root")
        self.resolved_connected = lists.resolve_connected(self.six, self.names, self.labels, self.routes, self.connected)

    def names_of(self, routes: DataFrame) -> DataFrame:
        """All alternate names, as lines would write them."""
        alt = routes.select("region", F.explode("alt_route_names").alias("alt"))
        return alt.select(T.ascii_upper(F.when(F.contains("alt", F.lit(" ")), F.col("alt")).otherwise(F.concat_ws(" ", "region", "alt"))).alias("name")).distinct()

    def directions(self) -> DataFrame:
        return connected.directions(self.ends.select("con_id", (F.col("root_order") - F.when(F.col("root") < 3, 1).otherwise(0)).alias("root_order"), "root", "a", "b", "n"))


_TL6 = """, ln6 AS (SELECT user_id AS trav, event_id AS line_no, upper('REG' || (p % 3) || ' R' || p) AS n1, 'P' || (k % 7) AS k1, upper('REG' || ((p + k % 4 - 1) % 3) || ' R' || (p + k % 4 - 1)) AS n2, 'P' || (k % 5) AS k2 FROM (SELECT *, event_id % (SELECT count(*) + 50 FROM part) AS p, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
s6 AS (SELECT trav, line_no, n1, k1, n2, k2, a.root AS r1, b.root AS r2, a.root - a.root % 3 AS c1, CAST(a.root % 3 AS INTEGER) AS o1, CAST(b.root % 3 AS INTEGER) AS o2, x.idx AS i1, y.idx AS i2, CASE WHEN a.root IS NULL OR b.root IS NULL THEN 'unknown route' WHEN a.root - a.root % 3 <> b.root - b.root % 3 THEN 'different connected routes' WHEN lvl = 'devel' THEN 'devel'
 WHEN x.idx IS NULL OR y.idx IS NULL THEN 'label missing' WHEN x.dup OR y.dup THEN 'duplicate label' WHEN a.root = b.root AND x.idx = y.idx THEN 'zero distance' ELSE 'ok' END AS status
 FROM ln6 LEFT JOIN nm a ON a.name = n1 LEFT JOIN nm b ON b.name = n2 LEFT JOIN rt ON rt.root = a.root LEFT JOIN lb x ON x.root = a.root AND x.key = k1 LEFT JOIN lb y ON y.root = b.root AND y.key = k2),
o6 AS (SELECT *, (o1, i1) > (o2, i2) AS sw FROM s6 WHERE status = 'ok'),
e6 AS (SELECT trav, line_no, c1, CASE WHEN sw THEN o2 ELSE o1 END AS fo, CASE WHEN sw THEN i2 ELSE i1 END AS fi, CASE WHEN sw THEN o1 ELSE o2 END AS to_, CASE WHEN sw THEN i1 ELSE i2 END AS ti FROM o6) """


@query("j02_route_lookup", _TL + "SELECT line_no, root, deprecated FROM st WHERE root IS NOT NULL", base=False)
def route_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).resolved.where("root IS NOT NULL").select("line_no", "root", "deprecated")


@query("j03_label_lookup", _TL + "SELECT root, key, idx, dup AS duplicate FROM lb", base=False)
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).labels


@query("w05_route_names", _TL + "SELECT name, root, deprecated FROM nm", base=False)
def route_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).names


@query("tl01_line_kinds", _TL + ", k AS (SELECT CASE WHEN line_no % 5 = 0 THEN 'incorrect format' WHEN line_no % 2 = 0 THEN 'connected' ELSE 'chopped' END AS kind FROM ln4) SELECT kind, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY kind", base=False)
def line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("line_no") % 5 == 0, 3).when(F.col("line_no") % 2 == 0, 6).otherwise(4)
    lines = Lists(spark, sf_dir).lines.withColumn("fields", F.slice(F.concat("fields", "fields"), F.lit(1), n))
    return lists.line_kind(lines).groupBy("kind").agg(F.count("*").alias("n"))


@query("tl02_chopped_status", _TL + "SELECT trav AS traveler, line_no, status FROM st", base=False)
def chopped_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).resolved.select("traveler", "line_no", "status")


@query("tl03_chopped_ranges", _TL + "SELECT line_no, root, least(i1, i2) AS beg, greatest(i1, i2) AS fin, i1 > i2 AS reverse FROM st WHERE status = 'ok'", base=False)
def chopped_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).resolved.where("status = 'ok'").select("line_no", "root", "beg", F.col("end").alias("fin"), "reverse")


@query("tl04_connected_status", _TL + _TL6 + "SELECT trav AS traveler, line_no, status FROM s6", base=False)
def connected_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).resolved_connected.select("traveler", "line_no", "status")


@query("tl05_connected_ranges", _TL + _TL6 + """, j AS (SELECT e.*, root, root % 4 = 1 AS rev, CAST(root % 3 AS INTEGER) AS o, CASE WHEN root % 7 = 0 THEN 6 ELSE 5 END AS last FROM e6 e JOIN rt ON root - root % 3 = c1 AND root % 3 BETWEEN fo AND to_)
SELECT line_no, root, CAST(CASE WHEN o = fo AND o = to_ THEN least(fi, ti) WHEN o = fo THEN CASE WHEN rev THEN 0 ELSE fi END WHEN o = to_ THEN CASE WHEN rev THEN ti ELSE 0 END ELSE 0 END AS INTEGER) AS beg,
 CAST(CASE WHEN o = fo AND o = to_ THEN greatest(fi, ti) WHEN o = fo THEN CASE WHEN rev THEN fi ELSE last END WHEN o = to_ THEN CASE WHEN rev THEN last ELSE ti END ELSE last END AS INTEGER) AS fin FROM j""", base=False)
def connected_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Lists(spark, sf_dir)
    return lists.connected_ranges(at.resolved_connected, at.connected, at.lengths).select("line_no", "root", "beg", F.col("end").alias("fin"))


@query("tl06_segment_dedupe", _TL + "SELECT DISTINCT trav AS traveler, root, CAST(unnest(range(least(i1, i2), greatest(i1, i2))) AS INTEGER) AS idx FROM st WHERE status = 'ok'", base=False)
def segment_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Lists(spark, sf_dir)
    return travel.covered(at.resolved.where("status = 'ok'"), at.segments).distinct()


#: Labels and names that lines mark, from lines of four fields and of six.
_MARKS = _TL.replace("WITH rt", "WITH RECURSIVE rt", 1) + _TL6 + """, mk AS (SELECT root, name, unnest([k1, k2]) AS key FROM st WHERE status IN ('ok', 'duplicate label') UNION ALL SELECT r1, n1, k1 FROM s6 WHERE status IN ('ok', 'duplicate label') UNION ALL SELECT r2, n2, k2 FROM s6 WHERE status IN ('ok', 'duplicate label')),
ls AS (SELECT root - root % 3 AS con, root, CAST(root % 3 - CASE WHEN root < 3 THEN 1 ELSE 0 END AS INTEGER) AS o, root * 5 % 4 AS a, (root * 7 + 1) % 4 AS b, 6 AS n FROM rt), """ + WALK


@query("tl07_names_in_use", _TL + "SELECT DISTINCT root FROM st WHERE status IN ('ok', 'duplicate label')", base=False)
def names_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lists(spark, sf_dir).resolved.where(F.col("status").isin("ok", "duplicate label")).select("root").distinct()


@query("tl07_labels_in_use", _MARKS + "SELECT DISTINCT root, key FROM mk", base=False)
def labels_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that good lines and lines with a label that stands twice mark, of single and of connected routes."""
    at = Lists(spark, sf_dir)
    return lists.marks(at.resolved, at.resolved_connected)[0]


@query("tl08_broken_warnings", _MARKS + """, bk AS (SELECT con, root FROM directions WHERE broken UNION SELECT con, before FROM directions WHERE broken), fr AS (SELECT con, reg, min(root) AS o FROM bk JOIN rt USING (root) GROUP BY ALL), tx AS (SELECT con, string_agg(reg, '/' ORDER BY o) AS regs FROM fr GROUP BY con)
SELECT trav AS traveler, line_no, regs || ': DISCONNECTED_ROUTE error in C' || con || '.' AS message FROM s6 JOIN tx ON con = c1 WHERE status = 'ok' AND r1 <> r2""", base=False)
def broken_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings for entries between two roots of a connected route whose roots do not all meet."""
    at = Lists(spark, sf_dir)
    named = at.routes.join(lists.shuffled(at.connected.select("root", "con_id")), "root").select("root", "region", F.concat(F.lit("C"), F.col("con_id").cast("string")).alias("con_name"))
    return lists.broken_warnings(at.resolved_connected, at.directions(), named)


@query("snk07_usage_logs", _MARKS + """, ul AS (SELECT DISTINCT root, key FROM mk), un AS (SELECT DISTINCT name FROM mk), nt AS (SELECT root, CASE WHEN root % 7 = 0 THEN 7 ELSE 6 END AS n FROM rt), sy AS (SELECT root, 'S' || root % 6 AS sys FROM rt), ua AS (SELECT DISTINCT root, 'Q' || k AS key FROM rt, (SELECT unnest(range(6)) AS k) WHERE root % 3 = 0 EXCEPT SELECT root, key FROM ul),
na AS (SELECT sys, name, pos FROM nm0 JOIN sy USING (root)), ur AS (SELECT DISTINCT sys, name FROM na WHERE pos > 0 AND name NOT IN (SELECT name FROM un))
SELECT 'pointsinuse' AS log, CAST(root AS VARCHAR) AS name, root || '(' || any_value(n) || '):' || string_agg(' ' || key, '' ORDER BY key) AS value FROM ul JOIN nt USING (root) GROUP BY root
UNION ALL SELECT 'unusedaltlabels', CAST(root AS VARCHAR), root || '(' || count(*) || '):' || string_agg(' ' || key, '' ORDER BY key) FROM ua GROUP BY root UNION ALL SELECT 'unusedaltlabels', NULL, 'Total: ' || count(*) FROM ua
UNION ALL SELECT 'listnamesinuse', sys, sys || '(' || (SELECT count(*) FROM sy y WHERE y.sys = x.sys) || '):' || string_agg(' "' || name || '"', '' ORDER BY name) FROM (SELECT DISTINCT sys, name FROM na WHERE name IN (SELECT name FROM un)) x GROUP BY sys
UNION ALL SELECT 'unusedaltroutenames', sys, sys || '(' || count(*) || '):' || string_agg(' "' || name || '"', '' ORDER BY name) FROM ur GROUP BY sys UNION ALL SELECT 'unusedaltroutenames', NULL, 'Total: ' || count(*) FROM ur
UNION ALL SELECT 'flippedroutes', CAST(root AS VARCHAR), CAST(root AS VARCHAR) FROM directions WHERE reversed""", base=False)
def usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and names in use and those nobody uses, and routes that run against their connected route."""
    at = Lists(spark, sf_dir)
    used, names = lists.marks(at.resolved, at.resolved_connected)
    return lists.usage_logs(used.checkpoint(), names.checkpoint(), at.lengths, at.all_labels, at.routes, at.directions().where("reversed").select("root"))


@query("tl09_control_characters", "SELECT doc_id, regexp_replace(text, '[\\x00-\\x08\\x0A-\\x1F\\x7F]', '?', 'g') AS line FROM documents", base=False)
def control_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "documents").select("doc_id", T.without_controls(F.col("text")).alias("line"))


@query("tl10_good_lines", _TL + """, g AS (SELECT trav, count(*) FILTER (status = 'ok') AS n FROM st GROUP BY trav), s AS (SELECT trav, count(*) AS m FROM (SELECT DISTINCT trav, root, unnest(range(least(i1, i2), greatest(i1, i2))) AS i FROM st WHERE status = 'ok') GROUP BY trav)
SELECT g.trav AS traveler, 'Processed ' || n || ' good lines marking ' || coalesce(m, 0) || ' segments.' AS message FROM g LEFT JOIN s ON g.trav = s.trav""", base=False)
def good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Lists(spark, sf_dir)
    n = at.resolved.groupBy("traveler").agg(F.count_if(F.col("status") == "ok").alias("n"))
    m = travel.covered(at.resolved.where("status = 'ok'"), at.segments).distinct().groupBy("traveler").agg(F.count("*").alias("m"))
    return n.join(m, "traveler", "left").select("traveler", F.format_string("Processed %d good lines marking %d segments.", "n", F.coalesce("m", F.lit(0))).alias("message"))


@query("j11_unused_alternates", _MARKS + """, ul AS (SELECT DISTINCT root, key FROM mk), un AS (SELECT DISTINCT name FROM mk) SELECT 'label' AS kind, CAST(root AS VARCHAR) || ' Q' || k AS name FROM (SELECT root, k FROM rt, (SELECT unnest(range(6)) AS k) WHERE root % 3 = 0) a WHERE NOT EXISTS (SELECT 1 FROM ul WHERE ul.root = a.root AND ul.key = 'Q' || k)
UNION ALL SELECT DISTINCT 'route name', name FROM nm0 WHERE pos > 0 AND name NOT IN (SELECT name FROM un)""", base=False)
def unused_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternate labels and route names that no list line uses."""
    at = Lists(spark, sf_dir)
    labels, names = lists.marks(at.resolved, at.resolved_connected)
    alt = at.all_labels.where("pos > 0").select("root", F.col("label").alias("key")).join(lists.shuffled(labels), ["root", "key"], "left_anti")
    other = at.names_of(at.routes).join(lists.shuffled(names), "name", "left_anti")
    return alt.select(F.lit("label").alias("kind"), F.concat_ws(" ", F.col("root").cast("string"), "key").alias("name")).unionByName(other.select(F.lit("route name").alias("kind"), "name"))


@query("j15_list_updates", """, u AS (SELECT l_orderkey AS root, strftime(l_shipdate, '%Y-%m-%d') AS date, l_linenumber AS line_no FROM lineitem), n AS (SELECT root, date, line_no FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY date DESC, line_no) AS t FROM u) WHERE t = 1),
s AS (SELECT DISTINCT trav, (1992 + trav % 7) || '-06-01' AS since, root FROM ent) SELECT trav AS traveler, s.root, date, CAST(line_no AS BIGINT) AS line_no FROM s JOIN n ON n.root = s.root WHERE date >= since""")
def list_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest update of each route that a traveler lists, where it is not older than the list: an as-of join by two dates."""
    points = tables.points(spark, sf_dir)
    entries = tables.entries(spark, sf_dir, points.groupBy("root").agg(F.count("*").alias("n")))
    listed = entries.select("traveler", F.concat((F.col("traveler") % 7 + 1992).cast("string"), F.lit("-06-01")).alias("since"), "root").distinct()
    rows = tables.read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS root", "date_format(l_shipdate, 'yyyy-MM-dd') AS date", "CAST(l_linenumber AS BIGINT) AS line_no", "'' AS description")
    return listed.join(lists.latest_updates(rows), "root").where("date >= since").select("traveler", "root", "date", "line_no")


@query("j15_latest_updates", """WITH u AS (SELECT o_orderkey AS line_no, 'r' || o_custkey AS root, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders) SELECT root, date, line_no FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY date DESC, line_no) AS t FROM u) WHERE t = 1 AND date >= '1998-01-01'""", base=False)
def latest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "orders").selectExpr("o_orderkey AS line_no", "'r' || o_custkey AS root", "date_format(o_orderdate, 'yyyy-MM-dd') AS date", "'' AS description")
    return lists.latest_updates(rows).where("date >= '1998-01-01'").select("root", "date", "line_no")


# --- functions
_F = "SELECT doc_id, {0} FROM documents"


@query("fn05_number_text", "SELECT p_partkey, v, regexp_matches(split_part(v, '&', 1), '^(\\.[0-9]*|-[0-9]*\\.?[0-9]*|[0-9]+\\.?[0-9]*)$') AS ok FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '-' || p_size || '.5' WHEN 1 THEN p_size || '.5.1' WHEN 2 THEN '.' || p_size WHEN 3 THEN '1e' || p_size WHEN 4 THEN p_size || '&x=1' ELSE '--' || p_size END AS v FROM part)", base=False)
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = "CASE p_partkey % 6 WHEN 0 THEN '-' || p_size || '.5' WHEN 1 THEN p_size || '.5.1' WHEN 2 THEN '.' || p_size WHEN 3 THEN '1e' || p_size WHEN 4 THEN p_size || '&x=1' ELSE '--' || p_size END"
    return tables.read(spark, sf_dir, "part").selectExpr("p_partkey", f"{v} AS v").withColumn("ok", T.is_number(F.col("v")))


@query("fn07_exact_split", "SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN p_name ELSE NULL END AS second FROM part", base=False)
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.expr("p_brand || ';' || CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name || ';' END || CASE WHEN p_size % 3 = 1 THEN ';' ELSE '' END")
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.fields(v, ";", 3)[1].alias("second"))


@query("fn08_ascii_case", _F.format("translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS up, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low"), base=False)
def ascii_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "documents").select("doc_id", T.ascii_upper(F.col("text")).alias("up"), T.ascii_lower(F.col("text")).alias("low"))


@query("fn09_of_miles", "SELECT p_partkey, printf('%.2f of %.2f mi (', CAST(p_size AS DOUBLE), w) || CASE WHEN w = 0 THEN '-.--%' ELSE printf('%.2f%%', p_size * 100.0 / w) END || ')' AS told FROM (SELECT *, CASE WHEN p_size % 5 = 0 THEN 0.0 ELSE p_retailprice END AS w FROM part)", base=False)
def of_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.when(F.col("p_size") % 5 == 0, 0.0).otherwise(F.col("p_retailprice"))
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.of_miles(F.col("p_size").cast("double"), whole).alias("told"))


@query("fn10_quoted", "SELECT doc_id, replace(replace(text, 'e', ''''), '''', '''''') AS quoted FROM documents", base=False)
def quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "documents").select("doc_id", T.quoted(F.replace("text", F.lit("e"), F.lit("'"))).alias("quoted"))


@query("fn11_fifteen_digits", "SELECT DISTINCT format('{:.15g} {:.15g}', CAST(lat AS DOUBLE), lng / 8) AS place FROM pts")
def fifteen_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.points(spark, sf_dir).select("lat", "lng").distinct().select(F.concat_ws(" ", T.fifteen_digits(F.col("lat")), T.fifteen_digits(F.col("lng") / 8)).alias("place"))


@query("fn12_two_decimals", "SELECT p_partkey, printf('%.2f', p_retailprice / 3) AS x FROM part", base=False)
def two_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.fixed(F.col("p_retailprice") / 3, 2).alias("x"))


@query("fn15_six_digits", "SELECT p_partkey, p_brand || ' http://x/?lat=' || p_size || '.500000&lon=-' || p_size || '.250000' AS line FROM part", base=False)
def six_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.six_digits(F.expr("p_brand || ' http://x/?lat=' || p_size || '.5&lon=-' || p_size || '.25'")).alias("line"))


@query("fn18_names_route", "SELECT p_partkey, v = 'R5' OR v = 'R5Abc' OR starts_with(v, 'R5_') OR starts_with(v, 'R5Abc_') AS hit FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'R5' WHEN 1 THEN 'R5Abc_X' WHEN 2 THEN 'R50' WHEN 3 THEN 'R5_' || p_size ELSE 'R5Abcd' END AS v FROM part)", base=False)
def names_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'R5' WHEN 1 THEN 'R5Abc_X' WHEN 2 THEN 'R50' WHEN 3 THEN 'R5_' || p_size ELSE 'R5Abcd' END")
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.names_route(v, F.lit("R5"), F.lit(""), F.lit("Abc")).alias("hit"))


@query("fn19_reversed_border", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type || '/' || p_brand ELSE p_name END AS label FROM part", base=False)
def reversed_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.expr("CASE WHEN p_size % 2 = 0 THEN p_brand || '/' || p_type ELSE p_name END")
    return tables.read(spark, sf_dir, "part").select("p_partkey", T.reversed_border(v).alias("label"))


@query("fn20_number_values", "SELECT l_orderkey, CAST(max(l_extendedprice) AS VARCHAR) AS x FROM lineitem GROUP BY l_orderkey", base=False)
def number_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shortest text that reads back as the same number."""
    return tables.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").cast("string").alias("x"))
