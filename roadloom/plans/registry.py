"""Named queries, each a function of (spark, sf_dir), with the SQL that tells the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The route-network view of the driver tables in SQL; a statement uses what it needs.
BASE = """
WITH pts AS (
  SELECT l_orderkey AS root,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS idx,
    ((l_suppkey * 7919) % 1000) / 10 - 50 AS lat, ((l_suppkey * 104729) % 3000) / 10 - 150 AS lng,
    l_returnflag = 'R' AS hid, (CASE WHEN l_returnflag = 'R' THEN '+X' ELSE 'P' END) || l_suppkey AS label
  FROM lineitem),
rts AS (
  SELECT o_orderkey AS root, o_orderpriority AS sys, o_custkey AS con, n_name AS reg, r_name AS country, CASE WHEN o_orderkey % 3 = 1 THEN 'Cit' ELSE '' END AS abbrev,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'active' WHEN o_orderpriority = '3-MEDIUM' THEN 'preview' ELSE 'devel' END AS lvl
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
seg0 AS (
  SELECT root, idx, lat, lng, lead(lat) OVER w AS lat2, lead(lng) OVER w AS lng2 FROM pts WINDOW w AS (PARTITION BY root ORDER BY idx)),
seg AS (
  SELECT root, idx, lat, lng, lat2, lng2, lat = lat2 AND lng = lng2 AS zero,
    (lat < lat2 OR (lat = lat2 AND lng < lng2)) AS up,
    CAST(7926.2 AS DOUBLE) * asin(sqrt(least(pow(sin((radians(lat2) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin((radians(lng2) - radians(lng)) / 2), 2), CAST(1 AS DOUBLE)))) * CAST(1.02112 AS DOUBLE) AS len
  FROM seg0 WHERE lat2 IS NOT NULL),
grp AS (
  SELECT s.*, r.sys, r.lvl, r.con, r.reg, r.country,
    CASE WHEN up THEN lat ELSE lat2 END AS alat, CASE WHEN up THEN lng ELSE lng2 END AS alng,
    CASE WHEN up THEN lat2 ELSE lat END AS blat, CASE WHEN up THEN lng2 ELSE lng END AS blng
  FROM seg s JOIN rts r USING (root)),
shr AS (
  SELECT *, CASE WHEN zero THEN 1 ELSE count(*) OVER g END AS n_all,
    CASE WHEN zero THEN CAST(lvl = 'active' AS INTEGER) ELSE count(*) FILTER (lvl = 'active') OVER g END AS n_active,
    CASE WHEN zero THEN CAST(lvl <> 'devel' AS INTEGER) ELSE count(*) FILTER (lvl <> 'devel') OVER g END AS n_shown,
    CASE WHEN zero THEN 1 ELSE count(*) OVER (PARTITION BY alat, alng, blat, blng, zero, sys) END AS n_system
  FROM grp WINDOW g AS (PARTITION BY alat, alng, blat, blng, zero)),
npt AS (SELECT root, count(*) AS n FROM pts GROUP BY root),
ent0 AS (
  SELECT user_id AS trav, event_id AS line_no, event_id AS root, n, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events JOIN npt ON event_id = root),
ent AS (
  SELECT trav, line_no, root, CAST(least(k % n, (3 * k + 1) % n) AS INTEGER) AS beg, CAST(greatest(k % n, (3 * k + 1) % n) AS INTEGER) AS fin FROM ent0),
dir AS (SELECT DISTINCT trav, s.root, s.idx FROM ent e JOIN seg s ON e.root = s.root AND s.idx >= e.beg AND s.idx < e.fin),
prop AS (
  SELECT trav, root, idx FROM dir
  UNION
  SELECT DISTINCT d.trav, o.root, o.idx
  FROM dir d JOIN grp g ON d.root = g.root AND d.idx = g.idx
  JOIN grp o ON NOT g.zero AND NOT o.zero AND o.lvl <> 'devel' AND g.alat = o.alat AND g.alng = o.alng AND g.blat = o.blat AND g.blng = o.blng),
cli AS (SELECT p.trav, s.* FROM prop p JOIN shr s USING (root, idx))
"""


def query(name: str, sql: str | None = None, base: bool = True) -> Callable[[Query], Query]:
    """Registers a query; sql without `base` stands alone."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = (BASE if base else "") + sql
        return f

    return add
