"""Queries on output tables, logs and small tools."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sinks
from ..operators import checks, lists, network, stats, travel, userlog
from ..operators.numbering import culled, dense
from ..sources import tables
from ..storage import ensure_checkpoints
from .check_queries import LABELS, check_sql, labels, marked_rows
from .network_queries import NATIONS, Net
from .registry import query
from .source_queries import _TL, Lists


@query("snk01_waypoint_table", "SELECT CAST(row_number() OVER (ORDER BY root, idx) - 1 AS BIGINT) AS point_id, root, label, round(lat, 1) AS lat, round(lng, 1) AS lng FROM pts")
def waypoint_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.points(spark, sf_dir).select("root", "idx", "label", F.round("lat", 1).alias("lat"), F.round("lng", 1).alias("lng"))
    return dense(rows, ["root", "idx"], "point_id").select(F.col("point_id").cast("long"), "root", "label", "lat", "lng")


@query("snk01_clinched_table", ", ids AS (SELECT root, idx, CAST(row_number() OVER (ORDER BY root, idx) - 1 AS BIGINT) AS segment_id FROM seg) SELECT segment_id, trav AS traveler FROM prop JOIN ids USING (root, idx)")
def clinched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    ids = dense(net.segments.select("root", "idx"), ["root", "idx"], "segment_id")
    return net.clinched.join(ids, ["root", "idx"]).select(F.col("segment_id").cast("long"), "traveler")


@query("snk01_overall_mileage_table", "SELECT reg AS region, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 2) AS active, round(sum(len / n_shown), 2) AS active_preview FROM shr WHERE lvl <> 'devel' GROUP BY reg HAVING sum(len) <> 0")
def overall_mileage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Net(spark, sf_dir).groups.where("level <> 'devel'")
    per = rows.groupBy("region").agg(stats.miles(stats.active()).alias("active"), stats.miles(stats.shown()).alias("active_preview"), F.sum("length").alias("s"))
    return per.where("s <> 0").drop("s")


@query("snk01_insert_text", """WITH r AS (SELECT '(' || chr(39) || s_suppkey || chr(39) || ',' || chr(39) || replace(s_name, chr(39), chr(39) || chr(39)) || chr(39) || ')' AS row FROM supplier), n AS (SELECT row, row_number() OVER (ORDER BY row) - 1 AS n FROM r)
SELECT CAST(-2 AS BIGINT) AS part, 'DROP TABLE IF EXISTS suppliers;' AS value UNION ALL SELECT -1, 'CREATE TABLE suppliers (s_suppkey BIGINT, s_name TEXT);' UNION ALL SELECT CAST(n // 40 AS BIGINT), 'INSERT INTO suppliers VALUES' || chr(10) || string_agg(row, ',' || chr(10) ORDER BY row) || ';' FROM n GROUP BY n // 40""", base=False)
def insert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.sql_text(tables.read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "suppliers", batch=40)


@query("snk01_countries_table", "SELECT 'C' || r_regionkey AS code, r_name AS name FROM region", base=False)
def countries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "region").select(F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("code"), F.col("r_name").alias("name"))


@query("snk01_regions_table", "SELECT n_name AS code, n_name AS name, 'C' || n_regionkey AS country, 'C' || n_regionkey AS continent, 'nation' AS regiontype FROM nation", base=False)
def regions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.concat(F.lit("C"), F.col("n_regionkey").cast("string"))
    return tables.read(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), F.col("n_name").alias("name"), country.alias("country"), country.alias("continent"), F.lit("nation").alias("regiontype"))


@query("snk01_systems_table", "SELECT sys AS system, lvl AS level, CAST(left(sys, 1) AS INTEGER) AS tier, CAST(row_number() OVER (ORDER BY sys) - 1 AS BIGINT) AS csv_order FROM (SELECT DISTINCT sys, lvl FROM rts)")
def systems_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.routes(spark, sf_dir).select("system", "level").distinct()
    return dense(rows, ["system"], "csv_order").select("system", "level", F.substring("system", 1, 1).cast("int").alias("tier"), F.col("csv_order").cast("long"))


@query("snk01_routes_table", """SELECT sys AS system, reg AS region, 'R' || root AS route, abbrev, root, round(coalesce(m, 0), 2) AS mileage, CAST(row_number() OVER (PARTITION BY con ORDER BY root) - 1 AS BIGINT) AS root_order, CAST(row_number() OVER (ORDER BY root) - 1 AS BIGINT) AS csv_order
FROM rts LEFT JOIN (SELECT root, sum(len) AS m FROM seg GROUP BY root) USING (root)""")
def routes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A connected route's roots are a bounded list, numbered as an array."""
    net = Net(spark, sf_dir)
    miles = net.segments.groupBy("root").agg(F.sum("length").alias("m"))
    places = net.routes.groupBy("con_id").agg(F.array_sort(F.collect_list("root")).alias("roots")).select(F.posexplode("roots").alias("root_order", "root"))
    rows = dense(net.routes, ["root"], "csv_order").join(miles, "root", "left").join(places, "root")
    return rows.select("system", "region", F.concat(F.lit("R"), F.col("root").cast("string")).alias("route"), "abbrev", "root", F.round(F.coalesce("m", F.lit(0.0)), 2).alias("mileage"), F.col("root_order").cast("long"), F.col("csv_order").cast("long"))


@query("snk01_connected_routes_table", """, c AS (SELECT con, min(root) AS first_root, round(coalesce(sum(m), 0), 2) AS mileage FROM rts LEFT JOIN (SELECT root, sum(len) AS m FROM seg GROUP BY root) USING (root) GROUP BY con)
SELECT first_root, mileage, CAST(row_number() OVER (ORDER BY first_root) - 1 AS BIGINT) AS csv_order FROM c""")
def connected_routes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    miles = net.segments.groupBy("root").agg(F.sum("length").alias("m"))
    per = net.routes.join(miles, "root", "left").groupBy("con_id").agg(F.min("root").alias("first_root"), F.round(F.coalesce(F.sum("m"), F.lit(0.0)), 2).alias("mileage"))
    return dense(per.select("first_root", "mileage"), ["first_root"], "csv_order").select("first_root", "mileage", F.col("csv_order").cast("long"))


@query("snk01_connected_roots_table", "SELECT first_root, root FROM (SELECT root, min(root) OVER (PARTITION BY con) AS first_root FROM rts) WHERE root <> first_root")
def connected_roots_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the second root of a connected route on."""
    routes = tables.routes(spark, sf_dir).select("con_id", "root")
    first = routes.groupBy("con_id").agg(F.min("root").alias("first_root"))
    return routes.join(first, "con_id").where("root <> first_root").select("first_root", "root")


@query("snk01_segments_table", """, ids AS (SELECT root, idx, CAST(row_number() OVER (ORDER BY root, idx) - 1 AS BIGINT) AS id FROM pts) SELECT CAST(row_number() OVER (ORDER BY s.root, s.idx) - 1 AS BIGINT) AS segment_id, id AS waypoint1, id + 1 AS waypoint2, s.root FROM seg s JOIN ids USING (root, idx)""")
def segments_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment's second point is the next one after its first."""
    points = dense(tables.points(spark, sf_dir).select("root", "idx"), ["root", "idx"], "id").select("root", "idx", F.col("id").cast("long").alias("id"))
    last = points.groupBy("root").agg(F.max("idx").alias("last"))
    rows = points.join(last, "root").where("idx < last")
    return dense(rows.select("root", "idx", "id"), ["root", "idx"], "segment_id").select(F.col("segment_id").cast("long"), F.col("id").alias("waypoint1"), (F.col("id") + 1).alias("waypoint2"), "root")


@query("snk01_list_entries_table", "SELECT CAST(user_id AS VARCHAR) AS traveler, 'events of ' || user_id AS description, user_id % 5 <> 0 AS include_in_ranks FROM events GROUP BY user_id", base=False)
def list_entries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    return tables.read(spark, sf_dir, "events").select("user_id").distinct().select(user.alias("traveler"), F.concat(F.lit("events of "), user).alias("description"), (F.col("user_id") % 5 != 0).alias("include_in_ranks"))


@query("snk01_datacheck_errors_table", LABELS + f"SELECT *, root % 3 = 0 AS fp FROM ({check_sql()})", base=False)
def datacheck_errors_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.run(labels(spark, sf_dir), checks.lexical())
    return checks.matched(found, found.where("root % 3 = 0"))


@query("snk01_system_mileage_table", "SELECT sys AS system, reg AS region, round(sum(len / n_system), 2) AS mileage FROM shr WHERE lvl <> 'devel' GROUP BY ALL HAVING sum(len) <> 0")
def system_mileage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Net(spark, sf_dir).groups.where("level <> 'devel'").groupBy("system", "region")
    return rows.agg(stats.miles(F.col("length") / F.col("n_system")).alias("mileage"), F.sum("length").alias("s")).where("s <> 0").drop("s")


@query("snk04_system_pivot", """, m AS (SELECT trav, sys, reg, sum(len / n_system) AS v FROM cli WHERE lvl <> 'devel' GROUP BY ALL), t AS (SELECT sys, reg, sum(len / n_system) AS v FROM shr WHERE lvl <> 'devel' GROUP BY ALL), c AS (SELECT sys, CAST(trav AS VARCHAR) AS traveler, reg, v FROM m UNION ALL SELECT sys, 'TOTAL', reg, v FROM t)
SELECT sys AS system, traveler, round(sum(v), 1) AS total, """ + ", ".join(f"""round(coalesce(sum(v) FILTER (reg = '{n}'), 0), 1) AS "{n}\"""" for n in NATIONS) + " FROM c GROUP BY ALL HAVING sum(v) > 0")
def system_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every system's table of travelers with mileage there by region, with a Total column and a TOTAL row."""
    net = Net(spark, sf_dir)
    value = F.sum(F.col("length") / F.col("n_system")).alias("v")
    own = net.clinched_groups.groupBy("system", F.col("traveler").cast("string").alias("traveler"), "region").agg(value)
    whole = net.groups.where("level <> 'devel'").groupBy("system", F.lit("TOTAL").alias("traveler"), "region").agg(value)
    wide = own.unionByName(whole).groupBy("system", "traveler").pivot("region", NATIONS).agg(F.sum("v"))
    cells = [F.coalesce(F.col(n), F.lit(0.0)) for n in NATIONS]
    total = sum(cells, F.lit(0.0))
    return wide.where(total > 0).select("system", "traveler", F.round(total, 1).alias("total"), *(F.round(c, 1).alias(n) for c, n in zip(cells, NATIONS, strict=True)))


@query("snk05_route_stats", """SELECT 'system' AS kind, sys || ' / ' || reg AS name, round(sum(len / n_system), 1) AS miles FROM shr GROUP BY sys, reg UNION ALL SELECT 'region', reg, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 1) FROM shr GROUP BY reg UNION ALL SELECT 'route', CAST(root AS VARCHAR), round(sum(len), 1) FROM seg GROUP BY root""")
def route_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    part = lambda kind, name, rows, v: rows.groupBy(F.lit(kind).alias("kind"), name.alias("name")).agg(stats.miles(v, 1).alias("miles"))
    a = part("system", F.concat_ws(" / ", "system", "region"), net.groups, F.col("length") / F.col("n_system"))
    return a.unionByName(part("region", F.col("region"), net.groups, stats.active())).unionByName(part("route", F.col("root").cast("string"), net.segments, F.col("length")))


#: All kinds of lines with their sort keys.
_USERLOG = ", " + _TL.replace("WITH ", "", 1) + """, mx AS (SELECT trav, line_no, status, reg, st.root, 'reg' || (p % 3) || ' ' || CASE WHEN line_no % 6 = 0 THEN 'a' ELSE 'r' END || p || ' *P' || (k % 7) || ' ' || lower(k2) AS line, '*P' || (k % 7) AS l1, lower(k2) AS l2, i1 IS NULL AS m1, d1, d2
 FROM st JOIN (SELECT event_id AS line_no, event_id % (SELECT count(*) + 50 FROM part) AS p, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) USING (line_no) LEFT JOIN rt ON rt.root = st.root LEFT JOIN (SELECT root AS ra, key AS ka, dup AS d1 FROM lb) ON ra = st.root AND ka = k1 LEFT JOIN (SELECT root AS rb, key AS kb, dup AS d2 FROM lb) ON rb = st.root AND kb = k2),
ms AS (SELECT trav, line_no, CASE status WHEN 'unknown route' THEN ['Unknown region/highway combo in line: ' || line] WHEN 'devel' THEN ['Ignoring line matching highway in system in development: ' || line] WHEN 'both labels missing' THEN ['Waypoint labels ' || l1 || ' and ' || l2 || ' not found in line: ' || line]
 WHEN 'label missing' THEN ['Waypoint label ' || CASE WHEN m1 THEN l1 ELSE l2 END || ' not found in line: ' || line] WHEN 'duplicate label' THEN list_filter([CASE WHEN d1 THEN reg || ': duplicate label ' || l1 || ' in ' || root END, CASE WHEN d2 THEN reg || ': duplicate label ' || l2 || ' in ' || root END, '  Unable to parse line: ' || line], lambda x: x IS NOT NULL)
 ELSE ['Equivalent waypoint labels mark zero distance traveled in line: ' || line] END AS t FROM mx WHERE status <> 'ok'),
gl AS (SELECT trav, count(*) FILTER (status = 'ok') AS n FROM st GROUP BY trav), sg AS (SELECT trav, count(*) AS m FROM (SELECT DISTINCT trav, root, unnest(range(least(i1, i2), greatest(i1, i2))) AS i FROM st WHERE status = 'ok') GROUP BY trav),
cl AS (SELECT * FROM cli WHERE lvl <> 'devel'), sh AS (SELECT * FROM shr WHERE lvl <> 'devel'),
ra AS (SELECT reg, sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END) AS aw, sum(len / n_shown) AS pw FROM sh GROUP BY reg), ta AS (SELECT sum(aw) AS aw, sum(pw) AS pw FROM ra),
ro AS (SELECT trav, reg, sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END) AS am, sum(len / n_shown) AS pm FROM cl GROUP BY ALL), tot AS (SELECT trav, sum(am) AS am, sum(pm) AS pm FROM ro GROUP BY trav),
sr AS (SELECT sys, lvl, reg, sum(len / n_system) AS t FROM sh GROUP BY ALL), sy AS (SELECT sys, lvl, sum(t) AS t, count(*) AS n FROM sr GROUP BY ALL), so AS (SELECT trav, sys, reg, sum(len / n_system) AS m FROM cl GROUP BY ALL), sv AS (SELECT trav, sys, sum(m) AS m FROM so GROUP BY ALL),
rw AS (SELECT sys, con, root, sum(len) AS t, count(*) AS n FROM sh GROUP BY ALL), cw AS (SELECT sys, con, sum(t) AS t, sum(n) AS n, count(*) AS roots FROM rw GROUP BY ALL), rm AS (SELECT trav, sys, lvl, con, root, sum(len) AS m, count(*) AS n FROM cl GROUP BY ALL HAVING sum(len) > 0),
cm AS (SELECT trav, rm.sys, rm.lvl, rm.con, sum(rm.m) AS m, sum(rm.n) AS n, any_value(cw.t) AS t, any_value(cw.n) AS whole, any_value(roots) AS roots FROM rm JOIN cw ON cw.sys = rm.sys AND cw.con = rm.con GROUP BY ALL), sz AS (SELECT sys, count(*) AS size FROM cw GROUP BY sys),
ct AS (SELECT trav, cm.sys, lvl, count(*) AS driven, count(*) FILTER (n = whole) AS done, any_value(size) AS size FROM cm JOIN sz USING (sys) GROUP BY ALL),
gs AS (SELECT trav, count(*) FILTER (lvl = 'active') AS a1, count(*) FILTER (lvl = 'active' AND done = size) AS a2, count(*) FILTER (lvl = 'preview') AS p1, count(*) FILTER (lvl = 'preview' AND done = size) AS p2 FROM ct GROUP BY trav), nn AS (SELECT count(*) FILTER (lvl = 'active') AS na, count(*) FILTER (lvl = 'preview') AS np FROM sy),
us AS (SELECT user_id AS trav, (1992 + user_id % 7) || '-06-01' AS since FROM events GROUP BY user_id), up AS (SELECT DISTINCT ent.trav, o_orderkey AS root, strftime(o_orderdate, '%Y-%m-%d') AS date, reg FROM ent JOIN orders ON o_orderkey = ent.root JOIN rts ON rts.root = ent.root JOIN us ON us.trav = ent.trav WHERE strftime(o_orderdate, '%Y-%m-%d') >= since),
ln(trav, section, a, sub, b, c, d, e, value) AS (
 SELECT trav, 0, '', 0, '', line_no, k - 1, 0, t[k] FROM (SELECT *, unnest(range(1, len(t) + 1)) AS k FROM ms)
 UNION ALL SELECT gl.trav, 1, '', 0, '', 0, 0, 0, format('Processed {} good lines marking {} segments traveled.', n, coalesce(m, 0)) FROM gl LEFT JOIN sg ON sg.trav = gl.trav
 UNION ALL SELECT trav, 2, '', 0, '', 0, 0, 0, 'Clinched Highway Statistics' FROM tot
 UNION ALL SELECT trav, 2, '', 0, '', 0, 0, 1, 'Overall in active systems: ' || @{am|ta.aw} FROM tot, ta
 UNION ALL SELECT trav, 2, '', 0, '', 0, 0, 2, 'Overall in active+preview systems: ' || @{pm|ta.pw} FROM tot, ta
 UNION ALL SELECT trav, 2, '', 0, '', 0, 0, 3, 'Overall by region: (each line reports active only then active+preview)' FROM tot
 UNION ALL SELECT trav, 3, '', 0, reg, 0, 0, 0, reg || ': ' || @{am|aw} || ', ' || @{pm|pw} FROM ro JOIN ra USING (reg)
 UNION ALL SELECT trav, 4, sys, 0, '', 0, 0, 0, 'System ' || sys || ' (' || lvl || ') overall: ' || @{m|t} FROM sv JOIN sy USING (sys)
 UNION ALL SELECT trav, 4, sys, 1, '', 0, 0, 0, 'System ' || sys || ' by region:' FROM sv JOIN sy USING (sys) WHERE n > 1
 UNION ALL SELECT trav, 4, sys, 2, reg, 0, 0, 0, '  ' || reg || ': ' || @{m|t} FROM (SELECT sv.trav, sr.sys, sr.reg, sr.t, coalesce(so.m, 0) AS m FROM sv JOIN sy USING (sys) JOIN sr ON sr.sys = sv.sys LEFT JOIN so ON so.trav = sv.trav AND so.sys = sr.sys AND so.reg = sr.reg WHERE n > 1)
 UNION ALL SELECT trav, 4, sys, 3, '', 0, 0, 0, 'System ' || sys || ' by route (traveled routes only):' FROM sv
 UNION ALL SELECT trav, 4, sys, 4, '', con, 0, 0, 'C' || con || ': ' || @{m|t} FROM cm
 UNION ALL SELECT trav, 4, rm.sys, 4, '', rm.con, rm.root, 1, CASE WHEN roots = 1 THEN ' (R' || rm.root || ' only)' ELSE '  R' || rm.root || ': ' || @{m|rw.t} END FROM rm JOIN rw ON rw.sys = rm.sys AND rw.root = rm.root JOIN cw ON cw.sys = rm.sys AND cw.con = rm.con
 UNION ALL SELECT trav, 4, sys, 4, '', con, 4611686018427387904, 2, '' FROM cm WHERE roots > 1
 UNION ALL SELECT trav, 4, sys, 5, '', 0, 0, 0, 'System ' || sys || ' connected routes traveled: ' || #{driven|size} || ', clinched: ' || #{done|size} || '.' FROM ct
 UNION ALL SELECT trav, 5, '', 0, '', 0, 0, 0, '' FROM gs
 UNION ALL SELECT trav, 5, '', 0, '', 0, 0, 1, 'Traveled ' || #{a1|na} || ', Clinched ' || #{a2|na} || ' active systems' FROM gs, nn
 UNION ALL SELECT trav, 5, '', 0, '', 0, 0, 2, 'Traveled ' || #{p1|np} || ', Clinched ' || #{p2|np} || ' preview systems' FROM gs, nn
 UNION ALL SELECT trav, 6, '', 0, '', 0, 0, 0, '' FROM us UNION ALL SELECT trav, 6, '', 0, '', 0, 0, 1, 'Most recent updates for listed routes:' FROM us
 UNION ALL SELECT trav, 7, '', 0, date, root, 0, 0, date || ' | ' || reg || ' | R' || root || ' | ' || root || ' | opened' FROM up)
SELECT trav AS traveler, CAST(row_number() OVER (PARTITION BY trav ORDER BY section, a, sub, b, c, d, e, value) - 1 AS BIGINT) AS line_no, value FROM ln"""
_USERLOG = re.sub(r"@\{(.*?)\|(.*?)\}", r"format('{:.2f} of {:.2f} mi ({})', CAST(\1 AS DOUBLE), \2, CASE WHEN \2 = 0 THEN '-.--%' ELSE format('{:.2f}%', 100 * CAST(\1 AS DOUBLE) / \2) END)", _USERLOG)
_USERLOG = re.sub(r"#\{(.*?)\|(.*?)\}", r"format('{} of {} ({:.1f}%)', \1, \2, CAST(100 * \1 AS DOUBLE) / \2)", _USERLOG)


@query("snk06_user_logs", _USERLOG)
def user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every traveler's log: messages on list lines (of the routes of parts), then mileage by region, system and route and recent
    updates (of the network of orders)."""
    net, at = Net(spark, sf_dir), Lists(spark, sf_dir)
    ensure_checkpoints(net.points)
    f = F.col("fields")
    resolved = lists.resolve_chopped(at.lines, at.names, at.labels, at.routes, told=True).checkpoint()
    told = resolved.withColumns({"label1": f[2], "label2": f[3], "line": F.array_join(f, " ")})
    marked = travel.covered(resolved.where("status = 'ok'"), at.segments).distinct().groupBy("traveler").agg(F.count("*").alias("m"))
    totals = travel.route_totals(net.segments, net.routes).checkpoint()
    driven = travel.driven_roots(net.covered, net.segments, totals)
    dates = tables.read(spark, sf_dir, "events").select(F.col("user_id").alias("traveler")).distinct().withColumn("since", F.concat((F.col("traveler") % 7 + 1992).cast("string"), F.lit("-06-01")))
    opened = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("root"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit(0).alias("line_no"), F.lit("opened").alias("description"))
    updates = lists.latest_updates(opened).join(net.routes.select("root", "region"), "root").withColumn("route", F.concat(F.lit("R"), F.col("root").cast("string")))
    parts = [userlog.messages(told), userlog.processed(resolved, marked), *userlog.statistics(net.groups, driven, totals), userlog.recent_updates(net.entries.select("traveler", "root"), updates, dates)]
    return userlog.logs(parts)


@query("snk07_points_in_use", """SELECT root, string_agg(DISTINCT label, ' ' ORDER BY label) AS labels FROM (SELECT p.root, p.label FROM ent e JOIN pts p ON e.root = p.root AND p.idx IN (e.beg, e.fin) WHERE e.beg < e.fin) GROUP BY root""")
def points_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = Net(spark, sf_dir)
    ends = net.entries.where("beg < end").select("root", F.explode(F.array("beg", "end")).alias("idx")).distinct()
    return ends.join(net.points.select("root", "idx", "label"), ["root", "idx"]).groupBy("root").agg(F.concat_ws(" ", F.sort_array(F.collect_set("label"))).alias("labels"))


@query("snk08_concurrency_log", """, g AS (SELECT alat, alng, blat, blng, list(root || '#' || idx ORDER BY sys, root, idx) AS m FROM grp WHERE NOT zero GROUP BY ALL HAVING count(*) > 1)
SELECT CASE WHEN k = 2 THEN 'New' ELSE 'Extended' END AS kind, array_to_string(m[1 : k], ' ') AS members FROM (SELECT m, unnest(range(2, len(m) + 1)) AS k FROM g)""")
def concurrency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and Extended lines of pairs with several segments: each lists the members up to itself, as the log does."""
    rows = Net(spark, sf_dir).named.where("pair IS NOT NULL")
    name = F.concat_ws("#", F.col("root").cast("string"), F.col("idx").cast("string"))
    lists = rows.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("system", "root", "idx", name.alias("name")))).alias("m")).where("size(m) > 1")
    told = lists.select("m", F.explode(F.sequence(F.lit(2), F.size("m"))).alias("k"))
    return told.select(F.when(F.col("k") == 2, "New").otherwise("Extended").alias("kind"), F.concat_ws(" ", F.slice(F.col("m.name"), F.lit(1), F.col("k"))).alias("members"))


@query("snk08_augment_log", """SELECT DISTINCT trav AS traveler, p.root || '#' || p.idx AS segment FROM prop p ANTI JOIN dir USING (trav, root, idx)""")
def augment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that travelers have only by concurrency, not by their lists."""
    net = Net(spark, sf_dir)
    key = ["traveler", "root", "idx"]
    got = net.clinched.select(*key).join(net.direct.select(*key), key, "left_anti")
    return got.select("traveler", F.concat_ws("#", F.col("root").cast("string"), F.col("idx").cast("string")).alias("segment"))


_LINE = "concat_ws(';', CAST(root AS VARCHAR), label1, label2, label3, code, info)"


@query("snk11_check_log", LABELS + f", f AS ({check_sql()}) SELECT CAST(0 AS BIGINT) AS place, 'Route;Label1;Label2;Label3;Code;Info' AS line UNION ALL SELECT CAST(row_number() OVER (ORDER BY {_LINE}) AS BIGINT), {_LINE} FROM f WHERE root % 3 <> 0", base=False)
def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of all checks on labels: a header, then the lines of errors that aren't marked as false positives."""
    found = checks.run(labels(spark, sf_dir), checks.lexical())
    left = checks.matched(found, found.where("root % 3 = 0")).where("NOT fp")
    lines = dense(left.select(F.concat_ws(";", F.col("root").cast("string"), "label1", "label2", "label3", "code", "info").alias("line")), ["line"], "place")
    head = spark.range(1).select(F.col("id").alias("place"), F.lit("Route;Label1;Label2;Label3;Code;Info").alias("line"))
    return head.unionByName(lines.select((F.col("place") + 1).cast("long").alias("place"), "line"))


@query("snk11_unmatched_log", LABELS + f", f AS ({check_sql()}) SELECT {_LINE.replace('info)', chr(39) + 'old' + chr(39) + ')')} AS line FROM f WHERE root % 3 = 0 AND root % 2 = 1", base=False)
def unmatched_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """False positives that no error matches in all six fields."""
    found = checks.run(labels(spark, sf_dir), checks.lexical())
    six = ["root", "label1", "label2", "label3", "code", "info"]
    left = marked_rows(found).select(*six).exceptAll(found.select(*six))
    return left.select(F.concat_ws(";", F.col("root").cast("string"), *six[1:]).alias("line"))


@query("snk14_unprocessed_log", "SELECT p_name || '.wpt' AS line FROM part WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_partkey)", base=False)
def unprocessed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    return part.join(tables.read(spark, sf_dir, "supplier"), F.col("p_partkey") == F.col("s_suppkey"), "left_anti").select(F.concat("p_name", F.lit(".wpt")).alias("line"))


@query("j11_unused_and_unmatched", "SELECT 'used' AS kind, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderkey IN (SELECT event_id FROM events) UNION ALL SELECT 'unused', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events)", base=False)
def unused_and_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events = tables.read(spark, sf_dir, "orders").select("o_orderkey"), tables.read(spark, sf_dir, "events").select("event_id")
    on = F.col("o_orderkey") == F.col("event_id")
    n = lambda how, kind: orders.join(events, on, how).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return n("left_semi", "used").unionByName(n("left_anti", "unused"))


@query("j13_scalar_total", "SELECT c_custkey, round(100 * c_acctbal / t, 4) AS pct FROM customer CROSS JOIN (SELECT sum(abs(c_acctbal)) AS t FROM customer)", base=False)
def scalar_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tables.read(spark, sf_dir, "customer")
    total = customer.agg(F.sum(F.abs("c_acctbal")).alias("t"))  # one row
    return customer.crossJoin(F.broadcast(total)).select("c_custkey", F.round(100 * F.col("c_acctbal") / F.col("t"), 4).alias("pct"))


@query("j14_scalar_subquery", "SELECT o_orderkey, o_totalprice > (SELECT avg(o_totalprice) FROM orders) AS above FROM orders", base=False)
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read(spark, sf_dir, "orders")
    mean = orders.agg(F.avg("o_totalprice").alias("m")).scalar()
    return orders.select("o_orderkey", (F.col("o_totalprice") > mean).alias("above"))


@query("j16_split_region", """, n AS (SELECT root, count(*) AS n FROM pts GROUP BY root), o AS (SELECT con, r.root, coalesce(sum(n - 1) OVER (PARTITION BY con ORDER BY r.root ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM rts r JOIN n USING (root))
SELECT DISTINCT a.root, a.idx, b.root AS other_root, CAST(b.idx + o.off AS BIGINT) AS other_place FROM grp a JOIN grp b ON NOT a.zero AND NOT b.zero AND a.alat = b.alat AND a.alng = b.alng AND a.blat = b.blat AND a.blng = b.blng AND a.sys = b.sys AND a.reg <> b.reg JOIN o ON b.root = o.root WHERE a.reg = 'NATION_3'""")
def split_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of one region with the same-named ones in others, at their place along the whole connected route."""
    net = Net(spark, sf_dir)
    n = net.points.groupBy("root").agg(F.count("*").alias("n"))
    before = Window.partitionBy("con_id").orderBy("root").rowsBetween(Window.unboundedPreceding, -1)
    offset = net.routes.join(n, "root").select(F.col("root").alias("other_root"), F.coalesce(F.sum(F.col("n") - 1).over(before), F.lit(0)).alias("off"))
    rows = net.segments.join(net.routes, "root").where("pair IS NOT NULL")
    a = rows.where("region = 'NATION_3'").select("pair", "system", "root", "idx")
    b = rows.where("region <> 'NATION_3'").select("pair", "system", F.col("root").alias("other_root"), F.col("idx").alias("i"))
    return a.join(b, ["pair", "system"]).join(offset, "other_root").select("root", "idx", "other_root", (F.col("i") + F.col("off")).cast("long").alias("other_place")).distinct()


_SPLIT = """, g AS (SELECT *, 'R' || root % 7 AS name, reg || ' R' || root % 7 || ' ' || p.label || ' ' || q.label AS told FROM grp JOIN pts p USING (root, idx) JOIN (SELECT root, idx - 1 AS idx, label FROM pts) q USING (root, idx)),
n AS (SELECT alat, alng, blat, blng, count(*) AS n FROM g WHERE NOT zero GROUP BY ALL), m AS (SELECT alat, alng, blat, blng, name, count(*) AS n FROM g WHERE NOT zero GROUP BY ALL), k AS (SELECT alat, alng, blat, blng, name, reg, count(*) AS n FROM g WHERE NOT zero GROUP BY ALL),
t AS (SELECT g.*, CASE WHEN zero THEN 1 ELSE n.n END AS members, m.n - k.n AS matches FROM g LEFT JOIN n USING (alat, alng, blat, blng) LEFT JOIN m USING (alat, alng, blat, blng, name) LEFT JOIN k USING (alat, alng, blat, blng, name, reg) WHERE starts_with(reg, 'NATION_1')),
l AS (SELECT sys, root, idx, 0 AS s, 0 AS r, 0 AS i, CASE WHEN members = 1 THEN told || ' has no concurrencies' WHEN members % 2 = 1 THEN 'Odd number of concurrencies:' ELSE told || ' has ' || matches || ' concurrent segments with same name+banner in different region(s) (1 expected)' END AS value FROM t WHERE members = 1 OR members % 2 = 1 OR matches <> 1
 UNION ALL SELECT t.sys, t.root, t.idx, 1, o.root, o.idx, chr(9) || o.told FROM t JOIN g o USING (alat, alng, blat, blng) WHERE members > 1 AND members % 2 = 1 AND NOT o.zero AND NOT t.zero)
SELECT sys AS system, CAST(row_number() OVER (PARTITION BY sys ORDER BY root, idx, s, r, i) - 1 AS BIGINT) AS line_no, value FROM l"""


@query("snk14_split_region_log", _SPLIT)
def split_region_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each system, what looks wrong in the concurrencies of the regions whose codes begin alike, in route order: segments
    without any, groups of an odd size with their members, and other than one match of name and banner in another region.
    Routes go by few names here."""
    named = network.between(tables.steps(spark, sf_dir), "label", "label2").join(tables.routes(spark, sf_dir), "root")
    name = F.concat(F.lit("R"), (F.col("root") % 7).cast("string"))
    told = named.select("pair", "root", "idx", "system", "region", name.alias("name"), F.concat_ws(" ", "region", name, "label", "label2").alias("told"))
    return checks.split_region(told, "NATION_1")


@query("s02_sorted_lists", "SELECT root, string_agg(label, ' ' ORDER BY label, idx) AS labels FROM pts GROUP BY root")
def sorted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.points(spark, sf_dir).groupBy("root").agg(F.concat_ws(" ", F.sort_array(F.collect_list("label"))).alias("labels"))


@query("s03_update_order", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) - 1 AS BIGINT) AS place FROM orders", base=False)
def update_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderkey")
    return dense(rows, ["date", "o_orderkey"], "place").select("o_orderkey", F.col("place").cast("long"))


@query("s05_region_order", "SELECT n_name AS code, CAST(row_number() OVER (ORDER BY n_name) AS INTEGER) AS place FROM nation", base=False)
def region_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions by code; the table is a small dimension."""
    return tables.read(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), F.row_number().over(Window.orderBy("n_name")).alias("place"))


@query("s06_long_labels", LABELS + "SELECT root, label FROM lab WHERE length(label) >= 15", base=False)
def long_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).where(F.length("label") >= 15).select("root", "label")


@query("set04_line_difference", "SELECT p_name AS line, CAST(count(*) AS BIGINT) AS n FROM (SELECT p_name FROM part EXCEPT ALL SELECT p_name FROM part WHERE p_size % 3 = 0) GROUP BY p_name", base=False)
def line_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    kept = part.select("p_name").exceptAll(part.where("p_size % 3 = 0").select("p_name"))
    return kept.groupBy(F.col("p_name").alias("line")).agg(F.count("*").alias("n"))


@query("set04_ordered_cull", """WITH g AS (SELECT p_type AS line, count(*) AS n FROM part WHERE p_size % 3 = 0 GROUP BY p_type), o AS (SELECT p_partkey AS place, p_type AS line, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS nth FROM part)
SELECT place, line FROM o LEFT JOIN g USING (line) WHERE nth > coalesce(n, 0)""", base=False)
def ordered_cull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (types of parts) less one copy for each line of another file, in their order."""
    part = tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("place"), F.col("p_type").alias("line"), "p_size")
    return culled(part.select("place", "line"), part.where("p_size % 3 = 0").select("line"), ["place"])


@query("a20_longest_values", """SELECT 'p_name' AS column_name, arg_max(p_name, (length(p_name), -p_partkey)) AS longest FROM part UNION ALL SELECT 'p_brand', arg_max(p_brand, (length(p_brand), -p_partkey)) FROM part UNION ALL SELECT 'p_type', arg_max(p_type, (length(p_type), -p_partkey)) FROM part""", base=False)
def longest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first longest value of each column, in one pass."""
    part, names = tables.read(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"]
    best = part.agg(*(F.max_by(c, F.struct(F.length(c), -F.col("p_partkey"))).alias(c) for c in names))
    return best.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("longest")) for c in names))).alias("x")).select("x.*")


@query("a21_route_numbers", """, nb AS (SELECT CAST(root % 700 AS BIGINT) AS number, 'R' || (root % 700) || sys AS route FROM rts) SELECT number, string_agg(DISTINCT route, ',' ORDER BY route) AS routes FROM nb GROUP BY number UNION ALL SELECT n, NULL FROM (SELECT unnest(range(1, 1000)) AS n) WHERE n NOT IN (SELECT number FROM nb)""")
def route_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes by the number in their name; numbers of 1 to 999 without a route have none."""
    name = F.concat(F.lit("R"), (F.col("root") % 700).cast("string"))
    rows = tables.routes(spark, sf_dir).select(F.regexp_replace(name, "[^0-9]", "").cast("long").alias("number"), F.concat(name, F.col("system")).alias("route"))
    found = rows.groupBy("number").agg(F.concat_ws(",", F.sort_array(F.collect_set("route"))).alias("routes"))
    missing = spark.range(1, 1000).select(F.col("id").alias("number")).join(found.select("number"), "number", "left_anti")
    return found.unionByName(missing.withColumn("routes", F.lit(None).cast("string")))


@query("m01_rank_tables", """, m AS (SELECT trav, reg, round(sum(CASE WHEN lvl = 'active' THEN len / n_active ELSE 0 END), 2) AS am FROM cli WHERE lvl <> 'devel' GROUP BY ALL), s AS (SELECT trav, round(sum(am)) AS miles FROM m GROUP BY trav)
SELECT trav AS traveler, miles, CAST(rank() OVER (ORDER BY miles DESC) AS INTEGER) AS miles_rank FROM s""")
def rank_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Net(spark, sf_dir).clinched_groups.groupBy("traveler", "region").agg(stats.miles(stats.active()).alias("am"))
    totals = rows.groupBy("traveler").agg(stats.whole_miles(F.col("am")).alias("miles"))
    return stats.ranked(totals, {"miles": "miles_rank"}, F.lit(True))
