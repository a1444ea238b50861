"""Resolution of travel-list lines: names to routes, labels to points, and the status of every line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_upper, label_key


def shuffled(rows: DataFrame) -> DataFrame:
    """Rows whose next join is a sort-merge join. Spark takes exploded rows for as few as there were before, so labels or names of
    many routes would be broadcast, through the driver's memory."""
    return rows.hint("merge")


def route_names(routes: DataFrame) -> DataFrame:
    """First-wins index of readable names in ASCII upper case. routes: root, region, list_name, alt_route_names, route_order.

    Primary names go before alternates; an alternate with a blank in it stands as it is, else after the region."""
    primary = routes.select("root", "route_order", F.lit(0).alias("pos"), ascii_upper(F.concat_ws(" ", "region", "list_name")).alias("name"))
    alt = routes.select("root", "region", "route_order", F.posexplode("alt_route_names").alias("pos", "alt"))
    alt = alt.select("root", "route_order", (F.col("pos") + 1).alias("pos"), ascii_upper(F.when(F.contains("alt", F.lit(" ")), F.col("alt")).otherwise(F.concat_ws(" ", "region", "alt"))).alias("name"))
    turn = Window.partitionBy("name").orderBy((F.col("pos") > 0), "route_order", "pos", "root")
    ranked = primary.unionByName(alt).withColumn("turn", F.row_number().over(turn))
    return ranked.where("turn = 1").select("name", "root", (F.col("pos") > 0).alias("deprecated"))


def point_labels(labels: DataFrame) -> DataFrame:
    """labels: root, idx, pos, label. Owners of the label keys, and whether a key is used twice in its route."""
    keyed = labels.withColumn("key", label_key(F.col("label")))
    first = keyed.groupBy("root", "key").agg(F.min(F.struct("idx", "pos")).alias("f"), F.count("*").alias("n"))
    return first.select("root", "key", F.col("f.idx").alias("idx"), (F.col("n") > 1).alias("duplicate"))


def resolve_chopped(lines: DataFrame, names: DataFrame, labels: DataFrame, routes: DataFrame, told: bool = False) -> DataFrame:
    """Lines of four fields: traveler, line_no, name and k1, k2 (the keys looked up), status, root, beg, end, reverse, deprecated.
    routes: root, level. Where messages are told: also the fields, the route's region, and missing1, missing2, twice1, twice2
    (which of the labels is unknown or stands twice).

    Failures in order: unknown route, in development, missing label(s), duplicate label, zero distance."""
    f = F.col("fields")
    four = lines.where(F.size("fields") == 4).select("traveler", "line_no", *(["fields"] if told else []), ascii_upper(F.concat_ws(" ", f[0], f[1])).alias("name"), label_key(f[2]).alias("k1"), label_key(f[3]).alias("k2"))
    at = lambda n: shuffled(labels.select(F.col("root").alias(f"r{n}"), F.col("key").alias(f"key{n}"), F.col("idx").alias(f"i{n}"), F.col("duplicate").alias(f"d{n}")))
    # names learn their levels first, so that lines of unknown names don't crowd on a root of null
    joined = four.join(shuffled(names.join(shuffled(routes.select("root", "level", *(["region"] if told else []))), "root", "left")), "name", "left")
    joined = joined.join(at(1), (F.col("root") == F.col("r1")) & (F.col("k1") == F.col("key1")), "left").join(at(2), (F.col("root") == F.col("r2")) & (F.col("k2") == F.col("key2")), "left")
    status = (
        F.when(F.col("root").isNull(), "unknown route")
        .when(F.col("level") == "devel", "devel")
        .when(F.col("i1").isNull() & F.col("i2").isNull(), "both labels missing")
        .when(F.col("i1").isNull() | F.col("i2").isNull(), "label missing")
        .when(F.col("d1") | F.col("d2"), "duplicate label")
        .when(F.col("i1") == F.col("i2"), "zero distance")
        .otherwise("ok")
    )
    ok = status == "ok"
    flags = [x for n in (1, 2) for x in (F.col(f"i{n}").isNull().alias(f"missing{n}"), F.coalesce(f"d{n}", F.lit(False)).alias(f"twice{n}"))]
    more = ["fields", "region", *flags] if told else []
    return joined.select(*more, "traveler", "line_no", "name", "k1", "k2", status.alias("status"), "root", F.when(ok, F.least("i1", "i2")).alias("beg"), F.when(ok, F.greatest("i1", "i2")).alias("end"), (ok & (F.col("i1") > F.col("i2"))).alias("reverse"), F.coalesce("deprecated", F.lit(False)).alias("deprecated"))


def resolve_connected(lines: DataFrame, names: DataFrame, labels: DataFrame, routes: DataFrame, connected: DataFrame) -> DataFrame:
    """Lines of six fields: status, the names (n1, n2), roots and label keys of both ends, and of good lines both ends in order.
    connected: con_id, root, root_order.

    Failures in order: unknown route(s), not the same connected route, in development, label missing, duplicate, zero distance."""
    f = F.col("fields")
    six = lines.where(F.size("fields") == 6).select("traveler", "line_no", *(x for n, k in ((1, 0), (2, 3)) for x in (ascii_upper(F.concat_ws(" ", f[k], f[k + 1])).alias(f"n{n}"), label_key(f[k + 2]).alias(f"k{n}"))))
    joined = six
    known = names.join(shuffled(connected.select("root", "con_id", "root_order")), "root", "left").join(shuffled(routes.select("root", "level")), "root", "left")
    for n in (1, 2):
        name = known.select(F.col("name").alias(f"n{n}"), F.col("root").alias(f"root{n}"), F.col("con_id").alias(f"c{n}"), F.col("root_order").alias(f"o{n}"), *(["level"] if n == 1 else []))
        lab = labels.select(F.col("root").alias(f"root{n}"), F.col("key").alias(f"k{n}"), F.col("idx").alias(f"i{n}"), F.col("duplicate").alias(f"d{n}"))
        joined = joined.join(shuffled(name), f"n{n}", "left").join(shuffled(lab), [f"root{n}", f"k{n}"], "left")
    status = (
        F.when(F.col("root1").isNull() | F.col("root2").isNull(), "unknown route")
        .when(F.col("c1").isNull() | F.col("c2").isNull() | (F.col("c1") != F.col("c2")), "different connected routes")
        .when(F.col("level") == "devel", "devel")
        .when(F.col("i1").isNull() | F.col("i2").isNull(), "label missing")
        .when(F.col("d1") | F.col("d2"), "duplicate label")
        .when((F.col("root1") == F.col("root2")) & (F.col("i1") == F.col("i2")), "zero distance")
        .otherwise("ok")
    )
    swap = F.struct("o1", "i1") > F.struct(F.col("o2").alias("o1"), F.col("i2").alias("i1"))
    pick = lambda c, first: F.when(swap if first else ~swap, F.col(f"{c}2")).otherwise(F.col(f"{c}1"))
    return joined.select("traveler", "line_no", status.alias("status"), F.col("c1").alias("con_id"), "n1", "root1", "k1", "n2", "root2", "k2", *(pick(c, first).alias(f"{n}_{c}") for n, first in (("from", True), ("to", False)) for c in ("o", "i")))


def connected_ranges(resolved: DataFrame, connected: DataFrame, lengths: DataFrame) -> DataFrame:
    """Good connected lines as one range for each root: traveler, line_no, root, beg, end. connected: + is_reversed; lengths: root, n."""
    good = resolved.where("status = 'ok'")
    each = good.join(shuffled(connected), "con_id").where(F.col("root_order").between(F.col("from_o"), F.col("to_o"))).join(shuffled(lengths), "root")
    last = F.col("n") - 1
    first_root, last_root = F.col("root_order") == F.col("from_o"), F.col("root_order") == F.col("to_o")
    turned = F.col("is_reversed")
    beg = F.when(first_root & last_root, F.least("from_i", "to_i")).when(first_root, F.when(turned, 0).otherwise(F.col("from_i"))).when(last_root, F.when(turned, F.col("to_i")).otherwise(0)).otherwise(0)
    end = F.when(first_root & last_root, F.greatest("from_i", "to_i")).when(first_root, F.when(turned, F.col("from_i")).otherwise(last)).when(last_root, F.when(turned, last).otherwise(F.col("to_i"))).otherwise(last)
    return each.select("traveler", "line_no", "root", beg.cast("int").alias("beg"), end.cast("int").alias("end"))


def line_kind(lines: DataFrame) -> DataFrame:
    n = F.size("fields")
    return lines.select("traveler", "line_no", F.when(n == 4, "chopped").when(n == 6, "connected").otherwise("incorrect format").alias("kind"))


def broken_warnings(resolved: DataFrame, directions: DataFrame, routes: DataFrame) -> DataFrame:
    """Good entries between two roots of a connected route that has breaks: traveler, line_no, message. directions: as
    connected.directions gives them; routes: root, region, con_name. Regions of roots on either side of a break are told in
    the order in which they first come."""
    broken = directions.where("broken").select("con_id", F.explode(F.array("root", "before")).alias("root")).distinct()
    placed = broken.join(shuffled(directions.select("root", "root_order")), "root").join(shuffled(routes.select("root", "region", "con_name")), "root")
    first = placed.groupBy("con_id", "con_name", "region").agg(F.min("root_order").alias("o"))
    # a connected route's regions, one name each, as the message lists them
    regions = first.groupBy("con_id", "con_name").agg(F.array_sort(F.collect_list(F.struct("o", "region"))).alias("r"))
    text = F.concat(F.array_join("r.region", "/"), F.lit(": DISCONNECTED_ROUTE error in "), "con_name", F.lit("."))
    return resolved.where("status = 'ok' AND root1 <> root2").join(shuffled(regions), "con_id").select("traveler", "line_no", text.alias("message"))


def marks(chopped: DataFrame, connected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What list lines use: labels (root, key) and route names (name). Good lines mark theirs, and so do lines with a label that
    stands twice in its route; lines of other failures mark nothing."""
    used = F.col("status").isin("ok", "duplicate label")
    one = chopped.where(used).select(F.explode(F.array(F.struct("root", "name", F.col("k1").alias("key")), F.struct("root", "name", F.col("k2").alias("key")))).alias("m"))
    end = lambda n: F.struct(F.col(f"root{n}").alias("root"), F.col(f"n{n}").alias("name"), F.col(f"k{n}").alias("key"))
    both = one.unionByName(connected.where(used).select(F.explode(F.array(end(1), end(2))).alias("m")))
    return both.select("m.root", "m.key").distinct(), both.select("m.name").distinct()


def usage_logs(labels_used: DataFrame, names_used: DataFrame, points: DataFrame, labels: DataFrame, routes: DataFrame, reversed_: DataFrame) -> DataFrame:
    """Five logs as lines (log, name, value): pointsinuse, unusedaltlabels, listnamesinuse, unusedaltroutenames, flippedroutes; name
    is what a log's lines go by (root or system; the last line of a log with a total has none).

    points: root, n; labels: root, idx, pos, label; routes: root, system, region, list_name, alt_route_names; reversed_: root.
    A line lists all names of one root or system, so these come together in one row; nothing else does."""
    line = lambda head, n, items, quote="": F.concat(head, F.lit("("), n.cast("string"), F.lit("):"), F.concat_ws("", F.transform(items, lambda x: F.concat(F.lit(f" {quote}"), x, F.lit(quote)))))
    log = lambda name, df, key, value: df.select(F.lit(name).alias("log"), key.cast("string").alias("name"), value.alias("value"))
    total = lambda name, df: df.agg(F.concat(F.lit("Total: "), F.count("*").cast("string")).alias("value")).select(F.lit(name).alias("log"), F.lit(None).cast("string").alias("name"), "value")
    root = F.col("root").cast("string")
    per_root = labels_used.groupBy("root").agg(F.sort_array(F.collect_set("key")).alias("items")).join(shuffled(points), "root")
    out = log("pointsinuse", per_root, root, line(root, F.col("n"), F.col("items")))
    alt = labels.where("pos > 0").select("root", label_key(F.col("label")).alias("key")).distinct().join(shuffled(labels_used), ["root", "key"], "left_anti")
    per_alt = alt.groupBy("root").agg(F.sort_array(F.collect_set("key")).alias("items"))
    out = out.unionByName(log("unusedaltlabels", per_alt, root, line(root, F.size("items"), F.col("items")))).unionByName(total("unusedaltlabels", alt))
    primary = routes.select("system", ascii_upper(F.concat_ws(" ", "region", "list_name")).alias("name"))
    other = routes.select("system", "region", F.explode("alt_route_names").alias("alt")).select("system", ascii_upper(F.when(F.contains("alt", F.lit(" ")), F.col("alt")).otherwise(F.concat_ws(" ", "region", "alt"))).alias("name"))
    used = primary.unionByName(other).join(shuffled(names_used), "name", "left_semi").groupBy("system").agg(F.sort_array(F.collect_set("name")).alias("items"))
    sizes = routes.groupBy("system").agg(F.count("*").alias("n"))
    out = out.unionByName(log("listnamesinuse", used.join(sizes, "system"), F.col("system"), line(F.col("system"), F.col("n"), F.col("items"), '"')))
    left = other.distinct().join(shuffled(names_used), "name", "left_anti")
    per_system = left.groupBy("system").agg(F.sort_array(F.collect_set("name")).alias("items"))
    out = out.unionByName(log("unusedaltroutenames", per_system, F.col("system"), line(F.col("system"), F.size("items"), F.col("items"), '"'))).unionByName(total("unusedaltroutenames", left))
    return out.unionByName(log("flippedroutes", reversed_, root, root))


def latest_updates(updates: DataFrame) -> DataFrame:
    """The newest update of each root; of equal dates the first line."""
    return updates.groupBy("root").agg(F.min_by(F.struct("date", "line_no", "description"), F.struct((-F.unix_date(F.to_date("date"))).alias("d"), "line_no")).alias("u")).select("root", "u.date", "u.line_no", "u.description")
