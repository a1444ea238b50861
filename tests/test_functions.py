"""Functions, native parsers and graph helpers on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F
from roadloom.functions import geometry, text
from roadloom.operators import connected, graph, lists, network, spatial, travel
from roadloom.shipping import ship
from roadloom.sources import graphs, native


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_distances_and_angles(spark):
    lit = lambda *x: [F.lit(float(v)) for v in x]
    quarter = one(spark, geometry.haversine(*lit(0, 0, 90, 0)))
    assert math.isclose(quarter, math.pi * 7926.2 / 4 * 1.02112, rel_tol=1e-12)
    assert math.isclose(one(spark, geometry.cosine_miles(*lit(0, 0, 0, 90))), math.pi / 2 * 3963.1, rel_tol=1e-12)
    assert one(spark, geometry.turn_angle(*lit(0, -1, 0, 0, 0, -1))) > 179
    assert one(spark, geometry.longitude_reach(*lit(89, 500))) == 180
    assert one(spark, geometry.wrapped(F.lit(370.0), 90.0)) == 10.0


def test_texts(spark):
    assert one(spark, text.ascii_upper(F.lit("straße é"))) == "STRAßE é"
    assert one(spark, text.label_key(F.lit("+*I-5n"))) == "I-5N"
    for value, good in (("1.5&x", True), ("-.5", True), ("1e5", False), ("1.2.3", False), ("--1", False)):
        assert one(spark, text.is_number(F.lit(value))) is good
    assert one(spark, text.of_miles(F.lit(1.0), F.lit(4.0))) == "1.00 of 4.00 mi (25.00%)"
    assert one(spark, text.of_miles(F.lit(0.0), F.lit(0.0))) == "0.00 of 0.00 mi (-.--%)"
    assert one(spark, text.fifteen_digits(F.lit(42.5))) == "42.5"


def rows_of(spark, *lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no int, value string")


def test_native_files(spark, tmp_path):
    good, bad = native.code_names(rows_of(spark, "code;name", "NA;North America\r", "", "EU;Europe;x", "TOOLONG;x"))
    assert [tuple(r) for r in good.collect()] == [("NA", "North America")] and bad.count() == 2
    systems, errors = native.systems(rows_of(spark, "h", "usai;USA;Interstate;blue;1;active", "# note", "usaus;USA;US;red;0;active", "usai;USA;Again;blue;1;active", 'x;USA;"q";b;1;devel'))
    assert [r["system"] for r in systems.collect()] == ["usai"] and errors.count() == 3
    routes, _ = native.routes(rows_of(spark, "h", "usai;CA;I-5;;;;CA.I005;Golden St,x", "usai;OR;I-5;;;;or.i005;"))
    assert sorted((r["root"], tuple(r["alt_route_names"])) for r in routes.collect()) == [("ca.i005", ("GOLDEN ST", "X")), ("or.i005", ())]
    con, errors = native.connected(rows_of(spark, "h", "usai;I-5;;;ca.i005,or.i005,wa.i005"), routes)
    assert sorted(r["root_order"] for r in con.collect()) == [0, 1] and errors.count() == 1
    folder = tmp_path / "CA" / "usai"
    folder.mkdir(parents=True)
    (folder / "ca.i005.wpt").write_bytes(b"A http://x/?lat=1.5&lon=2\r\n\r\n +X1  alt http://x/?lat=1.6&lon=2.1 \n")
    (tmp_path / "_boundaries").mkdir()
    (tmp_path / "_boundaries" / "z.wpt").write_text("B http://x/?lat=1&lon=2")
    files = native.route_files(spark, str(tmp_path))
    points = native.waypoints(native.waypoint_lines(files)).orderBy("idx").collect()
    assert [(p["root"], p["label"], p["alt_labels"], p["lat"], p["lng"], p["is_hidden"]) for p in points] == [("ca.i005", "A", [], 1.5, 2.0, False), ("ca.i005", "+X1", ["alt"], 1.6, 2.1, True)]
    spec, wrong = native.graph_specs(rows_of(spark, "h", "d;t;1;2;30", "d;t2;1;2;-1", "d;t3;1"), "area")
    assert [(r["graph"], r["description"]) for r in spec.collect()] == [("t30-area", "d (30 mi radius)")] and wrong.count() == 2


def test_travel_lists(spark):
    files = spark.createDataFrame([("me", "﻿CA I-5 A B # note\r\n\r\n# all\nCA I-5 A\nOR X A B\nCA old5 B A\n")], "traveler string, value string")
    lines = native.list_lines(files)
    assert [r["fields"] for r in lines.orderBy("line_no").collect()] == [["CA", "I-5", "A", "B"], ["CA", "I-5", "A"], ["OR", "X", "A", "B"], ["CA", "old5", "B", "A"]]
    routes = spark.createDataFrame([("r", "CA", "I-5", ["OLD5"], 0, "active")], "root string, region string, list_name string, alt_route_names array<string>, route_order int, level string")
    labels = spark.createDataFrame([("r", 0, 0, "A"), ("r", 1, 0, "+X"), ("r", 2, 0, "*B")], "root string, idx int, pos int, label string")
    got = lists.resolve_chopped(lines, lists.route_names(routes), lists.point_labels(labels), routes).orderBy("line_no").collect()
    assert [(r["status"], r["beg"], r["end"], r["reverse"], r["deprecated"]) for r in got] == [("ok", 0, 2, False, False), ("unknown route", None, None, False, False), ("ok", 0, 2, True, True)]


def network_of(spark):
    """Two routes that share a segment in opposite directions, one of them preview."""
    points = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 0.0, 1.0), ("a", 2, 0.0, 2.0), ("b", 0, 0.0, 2.0), ("b", 1, 0.0, 1.0), ("c", 0, 0.0, 1.0), ("c", 1, 0.0, 2.0)], "root string, idx int, lat double, lng double")
    routes = spark.createDataFrame([("a", "s1", "active", "R1"), ("b", "s2", "preview", "R2"), ("c", "s3", "devel", "R1")], "root string, system string, level string, region string")
    return points, routes


def test_split_mileage_and_propagation(spark):
    points, routes = network_of(spark)
    named = network.segments(points).join(routes, "root").cache()
    shared = network.shares(named).cache()
    counts = {(r["root"], r["idx"]): (r["n_all"], r["n_active"], r["n_shown"]) for r in shared.collect()}
    assert counts == {("a", 0): (1, 1, 1), ("a", 1): (3, 1, 2), ("b", 0): (3, 1, 2), ("c", 0): (3, 1, 2)}
    entries = spark.createDataFrame([("t", "b", 0, 1), ("t", "b", 0, 1), ("u", "b", 1, 1)], "traveler string, root string, beg int, end int")
    direct = travel.covered(entries, named)
    spread = travel.clinched(direct, named)
    assert sorted((r["traveler"], r["root"], r["idx"]) for r in spread.collect()) == [("t", "a", 1), ("t", "b", 0)]
    again = travel.clinched(spread.select("traveler", *named.columns), named)
    assert sorted(map(str, again.collect())) == sorted(map(str, spread.collect()))
    # sums by system and region tell the same miles
    groups = network.groups(named)
    summed = {r["system"]: r["m"] for r in travel.clinched_groups(direct, groups).groupBy("system").agg(F.sum(F.col("length") / F.col("n_shown")).alias("m")).collect()}
    single = spread.join(shared.select("root", "idx", "n_shown"), ["root", "idx"]).groupBy("system").agg(F.sum(F.col("length") / F.col("n_shown")).alias("m"))
    assert summed.keys() == {"s1", "s2"} and all(math.isclose(summed[r["system"]], r["m"]) for r in single.collect())


def test_ranks(spark):
    from roadloom.operators import stats

    values = [5.0, 3.0, 5.0, 1.0, 3.0, None]
    rows = spark.createDataFrame([(i, v, -i, i != 2) for i, v in enumerate(values)], "id int, x double, y int, ok boolean")
    got = {r["id"]: (r["rx"], r["ry"]) for r in stats.ranked(rows, {"x": "rx", "y": "ry"}, F.col("ok")).collect()}
    assert {k: v for k, v in got.items() if k != 5} == {0: (1, 1), 1: (2, 2), 2: (-1, -1), 3: (4, 3), 4: (2, 4)}


def test_cut_texts(spark):
    assert one(spark, text.cut_bytes(F.lit("aé日b"), 4)) == "aé" and one(spark, text.end_bytes(F.lit("aé日b"), 5)) == "日b"
    assert one(spark, text.shortened(F.lit("abcdefgh"), 6)) == "abc..." and one(spark, text.shortened(F.lit("abc"), 6)) == "abc"
    for value in (0.0, -30.25, 123.456789012345, 0.000125, 100000.5):
        assert one(spark, text.fifteen_digits(F.lit(value))) == f"{value:.15g}"


def test_near_misses_against_brute_force(spark):
    r = random.Random(1)
    rows = [(f"p{i}", r.uniform(0, 0.05), r.uniform(-0.05, 0)) for i in range(150)]
    got = {(x["name"], x["other"]) for x in spatial.near_misses(spark.createDataFrame(rows, "name string, lat double, lng double"), 0.003).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if abs(a[1] - b[1]) < 0.003 and abs(a[2] - b[2]) < 0.003 and a[1:] != b[1:]}
    assert got == want and all((b, a) in got for a, b in got)


def test_components_of_a_long_path(spark):
    r = random.Random(2)
    names = r.sample(range(1000), 120)
    edges = list(zip(names, names[1:], strict=False)) + [(2000, 2001), (2001, 2002)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: min(names) for n in names} | {2000: 2000, 2001: 2000, 2002: 2000}


def test_contraction_keeps_all_edges(spark):
    edges = spark.createDataFrame([(1, 2, "x"), (2, 3, "x"), (3, 9, "x"), (4, 9, "y"), (5, 6, "z"), (6, 7, "z"), (5, 7, "z")], "a long, b long, label string")
    visible = spark.createDataFrame([(1,), (9,), (4,)], "v long")
    got = sorted(map(tuple, graph.contract(edges, visible).drop("second").collect()))
    assert got == [(1, 9, "x", [2, 3]), (4, 9, "y", []), (5, 5, "z", [6, 7])]


def test_unique_names(spark):
    rows = [("v1", "N", "R1", "s1", True), ("v2", "N", "R1", "s2", False), ("v3", "N", "R1", "s3", False), ("v4", "N", "R2", "s4", False)]
    got = dict(map(tuple, graph.unique_names(spark.createDataFrame(rows, "v string, name string, region string, simple string, high boolean")).collect()))
    assert got == {"v1": "N", "v2": "N|R1", "v3": "s3", "v4": "N|R2"}


def test_traveler_codes(spark):
    rows = spark.createDataFrame([("e", t) for t in (0, 1, 5, 7)], "edge string, traveler int")
    travelers = spark.createDataFrame([(n, n) for n in range(12)], "traveler int, n int")
    assert graph.packed_travelers(rows, travelers, "edge").first()["code"] == "3A0"


def walked(ends):
    """The direction of each root of a connected route, one after the other: (broken, reversed)."""
    free, turned, broken = [True] + [False] * (len(ends) - 1), [False] * len(ends), [False] * len(ends)
    for k in range(1, len(ends)):
        (qa, qb), (ra, rb) = ends[k - 1], ends[k]
        end, begin = (qa, qb) if turned[k - 1] else (qb, qa)
        ahead = ends[k + 1] if k + 1 < len(ends) else ()
        if ra == end:
            continue
        if end == rb:
            if begin == ra and free[k - 1] and rb in ahead:
                turned[k - 1] = True
            else:
                turned[k] = True
        elif begin == rb and free[k - 1]:
            turned[k - 1] = turned[k] = True
        elif begin == ra and begin != rb and free[k - 1]:
            turned[k - 1] = True
        else:
            broken[k] = free[k] = True
    return list(zip(broken, turned, strict=True))


def test_directions_of_connected_routes(spark):
    r = random.Random(4)
    routes = {con: [tuple(r.choices(range(2 + con % 3), k=2)) for _ in range(r.randrange(1, 60))] for con in range(40)}
    routes[99] = [(0, 1), (1, 2), (2, 3)]
    rows = [(con, k, con * 1000 + k, (float(a), 0.0), (float(b), 0.0), 5) for con, ends in routes.items() for k, (a, b) in enumerate(ends)]
    listed = spark.createDataFrame(rows, "con_id int, root_order int, root int, a struct<lat:double,lng:double>, b struct<lat:double,lng:double>, n int")
    got = {(x["con_id"], x["root_order"]): (x["broken"], x["reversed"]) for x in connected.directions(listed).collect()}
    assert got == {(con, k): t for con, ends in routes.items() for k, t in enumerate(walked(ends))}
    # short routes meet anything; an empty table has no directions
    short = spark.createDataFrame([(1, 0, 1, (0.0, 0.0), (1.0, 0.0), 5), (1, 1, 2, (5.0, 0.0), (5.0, 0.0), 1)], listed.schema)
    assert connected.disconnected(short).count() == 0 and connected.directions(listed.limit(0)).count() == 0


def test_a_long_connected_route_is_no_single_task(spark):
    """Every root of 100,000 fits both ways on to the one before, so each direction hangs on all roots before it."""
    n = 100_000
    at = lambda c: F.struct((F.col("id") * 0.0 + c).alias("lat"), F.lit(0.0).alias("lng"))
    long = spark.range(n).select(F.lit(1).alias("con_id"), F.col("id").cast("int").alias("root_order"), F.col("id").alias("root"), at(F.when(F.col("id") % 2 == 1, F.col("id") + 1).otherwise(F.col("id"))).alias("a"), at(F.when(F.col("id") % 2 == 1, F.col("id")).otherwise(F.col("id") + 1)).alias("b"), F.lit(9).alias("n"))
    told = connected.directions(long)
    assert told.where("broken").count() == 0 and told.where("reversed").count() == n // 2


def test_graph_files_read_back(spark):
    lines = ["TMG 1.0 collapsed", "2 1", "a 1.5 2.5", "b 1 2", "0 1 R1,R2 3 4 5 6"]
    rows = spark.createDataFrame([("g", k, v) for k, v in enumerate(lines)], "graph string, line_no int, value string")
    vertices, edges = graphs.parse(rows)
    assert sorted((v["n"], v["name"], v["lat"]) for v in vertices.collect()) == [(0, "a", 1.5), (1, "b", 1.0)]
    assert [(e["v1"], e["v2"], e["name"], [tuple(p) for p in e["shape"]]) for e in edges.collect()] == [(0, 1, "R1,R2", [(3.0, 4.0), (5.0, 6.0)])]


def test_circles_over_poles_and_the_date_line(spark):
    r = random.Random(7)
    places = [(k, r.choice([r.uniform(-90, 90), r.uniform(85, 90), -r.uniform(85, 90), 90.0, -90.0]), r.choice([r.uniform(-180, 180), 180.0, -180.0, r.uniform(178, 180), -r.uniform(178, 180)])) for k in range(1500)]
    circles = [(f"c{k}", r.choice([r.uniform(-90, 90), 89.9, -89.5, 90.0]), r.choice([r.uniform(-180, 180), 179.9, -179.9]), r.choice([0.5, 20.0, 300.0, 2500.0, 9000.0, 13000.0])) for k in range(60)]

    def miles(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return math.acos(max(-1.0, min(1.0, math.cos(a) * math.cos(c) * math.cos(d - b) + math.sin(a) * math.sin(c)))) * 3963.1

    want = {(g, k) for k, lat, lng in places for g, clat, clng, radius in circles if miles(lat, lng, clat, clng) <= radius}
    at, around = spark.createDataFrame(places, "name int, lat double, lng double"), spark.createDataFrame(circles, "graph string, clat double, clng double, radius double")
    got = [(x["graph"], x["name"]) for x in spatial.within(at, around).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # few cells, however large or far north a circle is
    assert spatial.circle_cells(around).groupBy("graph").count().agg(F.max("count")).first()[0] <= 60
    spot = {k: {"lat": lat, "lng": lng} for k, lat, lng in places}
    ways = [(k, spot[k], spot[(k * 7) % 1500]) for k in range(1500)]
    edges = spark.createDataFrame(ways, "edge int, a struct<lat:double,lng:double>, b struct<lat:double,lng:double>")
    assert {(x["graph"], x["edge"]) for x in spatial.edges_within(edges, around).collect()} == {(g, k) for g, k in want if (g, (k * 7) % 1500) in want}
    assert spatial.within(at, around.limit(0)).count() == 0
