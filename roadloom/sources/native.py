"""Readers for the native text files. Every parser takes lines, so that tables of lines can be parsed too.

A parser gives good rows and error rows (message); a row of a wrong field count or an over-long field is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_lower, ascii_upper, is_number
from ..operators.checks import ALWAYS_ERROR

# Byte limits of fields.
LIMITS = {"code": 3, "name": 15, "country_name": 32, "region_code": 8, "region_name": 48, "region_type": 32, "system": 10, "full_name": 60, "color": 16, "route": 16, "banner": 6, "abbrev": 3, "city": 100, "root": 32, "group_name": 100, "label": 26}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one or many files: value, path, line_no (from 0 in each file). Order inside a file is kept by reading it whole."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return whole.select("path", F.posexplode(F.split("value", "\r\n|\n|\r", -1)).alias("line_no", "value"))


def csv_rows(rows: DataFrame, n: int, limits: list[int | None] | None = None, comment: str | None = None, skip_header: bool = True) -> tuple[DataFrame, DataFrame]:
    """rows: line_no, value. Semicolon rows with exactly n fields (array `f`), and errors (line_no, message)."""
    line = F.regexp_replace("value", "\r$", "")
    kept = rows.withColumn("value", line).where("value <> ''")
    if skip_header:
        kept = kept.where("line_no > 0")
    if comment:
        kept = kept.where(~F.col("value").startswith(comment))
    split = kept.withColumn("f", F.split("value", ";", -1))
    wrong = F.size("f") != n
    long_ = F.lit(False)
    for k, limit in enumerate(limits or []):
        if limit:
            long_ = long_ | (F.octet_length(F.get("f", F.lit(k))) > limit)
    message = F.when(wrong, F.format_string(f"%d fields instead of {n}: %s", F.size("f"), "value")).when(F.coalesce(long_, F.lit(False)), F.concat(F.lit("field too long: "), "value"))
    told = split.withColumn("message", message)
    return told.where("message IS NULL").select("line_no", "f"), told.where("message IS NOT NULL").select("line_no", "message")


def code_names(rows: DataFrame, limits: tuple[int, int] = (3, 15)) -> tuple[DataFrame, DataFrame]:
    """continents.csv and countries.csv: code, name."""
    good, bad = csv_rows(rows, 2, list(limits))
    return good.select(F.col("f")[0].alias("code"), F.col("f")[1].alias("name")), bad


def regions(rows: DataFrame, countries: DataFrame, continents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """regions.csv; unknown country or continent codes become `error` and are told."""
    good, bad = csv_rows(rows, 5, [8, 48, None, None, 32])
    named = good.select("line_no", *(F.col("f")[k].alias(c) for k, c in enumerate(("code", "name", "country", "continent", "region_type"))))
    countries, continents = countries.select(F.col("code").alias("c1")), continents.select(F.col("code").alias("c2"))
    joined = named.join(countries, F.col("country") == F.col("c1"), "left").join(continents, F.col("continent") == F.col("c2"), "left")
    errors = joined.where("c1 IS NULL OR c2 IS NULL").select("line_no", F.concat(F.lit("unknown country or continent of "), "code").alias("message"))
    fixed = joined.select("code", "name", F.when(F.col("c1").isNull(), "error").otherwise(F.col("country")).alias("country"), F.when(F.col("c2").isNull(), "error").otherwise(F.col("continent")).alias("continent"), "region_type")
    return fixed, bad.unionByName(errors)


def systems(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """systems.csv: six fields, # comments, no double quotes, tier at least 1, three levels, each code once."""
    good, bad = csv_rows(rows, 6, [10, None, 60, 16, None, None], comment="#")
    named = good.select("line_no", *(F.col("f")[k].alias(c) for k, c in enumerate(("system", "country", "full_name", "color", "tier", "level"))))
    tier = F.col("tier").try_cast("int")
    turn = F.row_number().over(Window.partitionBy("system").orderBy("line_no"))
    message = (
        F.when(F.contains("full_name", F.lit('"')), F.lit("double quotes in system name"))
        .when(tier.isNull() | (tier < 1), F.lit("invalid tier"))
        .when(~F.col("level").isin("active", "preview", "devel"), F.lit("unrecognized level"))
        .when(F.col("turn") > 1, F.lit("duplicate system name"))
    )
    told = named.withColumn("turn", turn).withColumn("message", message)
    errors = told.where("message IS NOT NULL").select("line_no", F.concat_ws(": ", "message", "system").alias("message"))
    return told.where("message IS NULL").select("system", "country", "full_name", "color", tier.alias("tier"), "level", F.col("line_no").alias("system_order")), bad.unionByName(errors)


def routes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """<system>.csv: eight fields; roots in lower case, alternate names in upper case and comma-split."""
    good, bad = csv_rows(rows, 8, [None, None, 16, 6, 3, 100, 32, None])
    f = F.col("f")
    alts = F.filter(F.split(ascii_upper(f[7]), ",", -1), lambda x: x != "")
    return good.select(f[0].alias("system"), f[1].alias("region"), f[2].alias("route"), f[3].alias("banner"), f[4].alias("abbrev"), f[5].alias("city"), ascii_lower(f[6]).alias("root"), alts.alias("alt_route_names"), F.col("line_no").alias("route_order")), bad


def connected(rows: DataFrame, routes_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """<system>_con.csv: five fields; one row for each root in order. Roots of no route or listed twice are errors."""
    good, bad = csv_rows(rows, 5, [None, 16, 6, 100, None])
    f = F.col("f")
    split = good.select("line_no", f[0].alias("system"), f[1].alias("route"), f[2].alias("banner"), f[3].alias("group_name"), F.split(ascii_lower(f[4]), ",", -1).alias("roots"))
    each = split.select("line_no", "system", "route", "banner", "group_name", F.col("roots")[0].alias("con_id"), F.posexplode("roots").alias("root_order", "root"))
    known = routes_.select(F.col("root").alias("known"), F.col("system").alias("of")).distinct()
    turn = F.row_number().over(Window.partitionBy("root").orderBy("line_no", "root_order"))
    joined = each.withColumn("turn", turn).join(known, F.col("root") == F.col("known"), "left")
    message = F.when(F.col("known").isNull(), F.lit("could not find root")).when(F.col("of") != F.col("system"), F.lit("system mismatch")).when(F.col("turn") > 1, F.lit("root listed twice"))
    told = joined.withColumn("message", message)
    errors = told.where("message IS NOT NULL").select("line_no", F.concat_ws(" ", "message", "root").alias("message"))
    return told.where("message IS NULL").select("con_id", "system", "route", "banner", "group_name", "root", "root_order"), bad.unionByName(errors)


def route_files(spark: SparkSession, folder: str) -> DataFrame:
    """All .wpt files below a folder but those under _boundaries, and texts in folders root=...: path, root, value (the whole text)."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{wpt,txt}").text(folder, wholetext=True)
    named = files.select(F.col("_metadata.file_path").alias("path"), "value").where(~F.contains("path", F.lit("/_boundaries/")))
    root = F.coalesce(*[F.nullif(F.regexp_extract("path", p, 1), F.lit("")) for p in (r"([^/]+)\.wpt$", r"/root=([^/]+)/part-[^/]+$")])
    return named.select("path", root.alias("root"), "value").where("root IS NOT NULL")


def waypoint_lines(files: DataFrame) -> DataFrame:
    """files: root, value. Lines trimmed of blanks and tabs, without blank ones, in order: root, idx, line."""
    each = files.select("root", F.transform(F.split("value", "[\r\n]+", -1), lambda x: F.regexp_replace(x, "^[ \t]+|[ \t]+$", "")).alias("all"))
    return each.select("root", F.posexplode(F.filter("all", lambda x: x != "")).alias("idx", "line"))


def coordinate(url: Column, key: str) -> Column:
    """The number after key= in a URL, up to the next &; null if it isn't a plain decimal."""
    text = F.substring_index(F.substring_index(url, f"{key}=", -1), "&", 1)
    return F.when(F.contains(url, F.lit(f"{key}=")) & is_number(text), text.try_cast("double"))


def waypoints(lines_: DataFrame) -> DataFrame:
    """root, idx, label, alt_labels, url, lat, lng, is_hidden: first field label, last URL, others alternate labels."""
    f = F.split("line", " +")
    rows = lines_.withColumn("f", f)
    label, url = F.col("f")[0], F.element_at("f", -1)
    alts = F.when(F.size("f") > 2, F.slice("f", 2, F.size("f") - 2)).otherwise(F.array().cast("array<string>"))
    return rows.select("root", "idx", label.alias("label"), alts.alias("alt_labels"), url.alias("url"), coordinate(url, "lat").alias("lat"), coordinate(url, "lon").alias("lng"), F.startswith(label, F.lit("+")).alias("is_hidden"))


def list_lines(files: DataFrame) -> DataFrame:
    """files: traveler, value. Fields of list lines up to the first that starts with #; blank lines go: traveler, line_no, fields, line."""
    text = F.regexp_replace("value", "^﻿", "")
    each = files.select("traveler", F.posexplode(F.split(text, "\r\n|\n|\r", -1)).alias("line_no", "line"))
    fields = F.filter(F.split("line", "[ \t]+"), lambda x: x != "")
    comment = F.array_position(F.transform(fields, lambda x: F.startswith(x, F.lit("#"))), True)
    kept = F.when(comment > 0, F.slice(fields, F.lit(1), (comment - 1).cast("int"))).otherwise(fields)
    return each.select("traveler", "line_no", kept.alias("fields"), "line").where(F.size("fields") > 0)


def lists(spark: SparkSession, folder: str, only: list[str] | None = None, extension: str = "list") -> DataFrame:
    files = spark.read.option("pathGlobFilter", f"*.{extension}").text(folder, wholetext=True)
    named = files.select(F.regexp_extract("_metadata.file_path", rf"([^/]+)\.{extension}$", 1).alias("traveler"), "value")
    return named.where(F.col("traveler").isin(only)) if only else named


def list_info(rows: DataFrame) -> DataFrame:
    """listfileinfo.csv: columns as its header says, row 2 the defaults for empty fields; the first of equal names counts."""
    head = rows.where("line_no = 0").first()
    if head is None:  # an empty file tells nothing, not even columns
        return rows.select(F.col("value").alias("traveler")).limit(0)
    names = head["value"].rstrip("\r").split(";")
    fields = rows.withColumn("f", F.split(F.regexp_replace("value", "\r$", ""), ";", -1)).where(F.size("f") == len(names))
    defaults = fields.where("line_no = 1").select(F.col("f").alias("d"))
    turn = F.row_number().over(Window.partitionBy(F.col("f")[0]).orderBy("line_no"))
    own = fields.where("line_no > 1").withColumn("turn", turn).where("turn = 1").crossJoin(F.broadcast(defaults))  # one row of defaults
    return own.select(F.col("f")[0].alias("traveler"), *(F.coalesce(F.nullif(F.col("f")[k], F.lit("")), F.col("d")[k]).alias(n) for k, n in enumerate(names) if k))


def updates(rows: DataFrame, limits: list[int | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """updates.csv: date (YYYY-MM-DD), region, route, root, description."""
    good, bad = csv_rows(rows, 5, limits or [10, 83, 80, 32, 1024])
    shaped = good.withColumn("ok", F.col("f")[0].rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))
    errors = shaped.where("NOT ok").select("line_no", F.concat(F.lit("no valid date: "), F.col("f")[0]).alias("message"))
    f = F.col("f")
    return shaped.where("ok").select("line_no", f[0].alias("date"), f[1].alias("region"), f[2].alias("route"), f[3].alias("root"), f[4].alias("description")), bad.unionByName(errors)


def system_updates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """systemupdates.csv: date, region, system, description, status_change; a date is only limited in length."""
    good, bad = csv_rows(rows, 5, [10, 83, 10, 60, 16])
    f = F.col("f")
    return good.select("line_no", *(f[k].alias(c) for k, c in enumerate(("date", "region", "system", "description", "status_change")))), bad


def false_positives(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """datacheckfps.csv: six fields; codes that are always errors are refused."""
    good, bad = csv_rows(rows, 6)
    named = good.select("line_no", *(F.col("f")[k].alias(c) for k, c in enumerate(("root", "label1", "label2", "label3", "code", "info"))))
    refused = named.where(F.col("code").isin(ALWAYS_ERROR)).select("line_no", F.concat(F.lit("always an error: "), "code").alias("message"))
    return named.where(~F.col("code").isin(ALWAYS_ERROR)).drop("line_no"), bad.unionByName(refused)


def near_miss_marks(rows: DataFrame) -> DataFrame:
    """nmpfps.log lines without their suffix, each once."""
    return rows.select(F.regexp_replace(F.regexp_replace("value", "\r$", ""), r" \[(SOME LOOK|LOOKS) INTENTIONAL\]$", "").alias("line")).where("line <> ''").distinct()


def update_dates(files: DataFrame) -> DataFrame:
    """files: traveler, value. The first ten characters of the first line."""
    return files.select("traveler", F.substring(F.substring_index("value", "\n", 1), 1, 10).alias("date"))


def graph_specs(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """area, multiregion, multisystem, system and fullcustom rows in one schema; empty fields of the first three collapse."""
    n = {"area": 5, "multiregion": 3, "multisystem": 3, "system": 1, "fullcustom": 7}[kind]
    kept = rows.where("line_no > 0").withColumn("value", F.regexp_replace("value", "\r$", "")).where("value <> ''")
    f = F.split("value", ";", -1)
    split = kept.withColumn("f", F.filter(f, lambda x: x != "") if kind in ("area", "multiregion", "multisystem") else f)
    codes = lambda k: F.filter(F.split(F.col("f")[k], ","), lambda x: x != "")
    number = lambda k: F.col("f")[k].try_cast("double")
    none, empty = F.lit(None).cast("double"), F.array().cast("array<string>")
    place = {"area": (2, 3, 4), "fullcustom": (2, 3, 4)}.get(kind)
    regions_ = codes(2) if kind == "multiregion" else codes(5) if kind == "fullcustom" else empty
    systems_ = codes(2) if kind == "multisystem" else F.array(F.col("f")[0]) if kind == "system" else codes(6) if kind == "fullcustom" else empty
    # files are named by title; of an area also by its radius, of a system by its name
    title = {"system": F.concat(F.col("f")[0], F.lit("-system")), "area": F.concat(F.col("f")[1], F.col("f")[4], F.lit("-area"))}.get(kind, F.col("f")[1])
    described = F.concat(F.col("f")[0], F.lit(" ("), F.col("f")[4], F.lit(" mi radius)")) if kind == "area" else F.col("f")[0]
    spec = split.where(F.size("f") == n).select("line_no", described.alias("description"), title.alias("graph"), F.lit(kind).alias("category"), regions_.alias("regions"), systems_.alias("systems"), *((number(k) if place else none).alias(c) for k, c in zip(place or (0, 0, 0), ("lat", "lng", "radius"), strict=True)))
    given = F.size(F.array_compact(F.array("lat", "lng", "radius")))
    wrong = (given != 3) if kind == "area" else (~given.isin(0, 3)) if kind == "fullcustom" else F.lit(False)
    wrong = wrong | F.coalesce(F.col("radius") <= 0, F.lit(False))
    counted = split.where(F.size("f") != n).select("line_no", F.concat(F.lit("wrong field count: "), "value").alias("message"))
    return spec.where(~wrong).drop("line_no"), counted.unionByName(spec.where(wrong).select("line_no", F.concat(F.lit("invalid place: "), "graph").alias("message")))
