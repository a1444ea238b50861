"""Audit of how far the sources of a language diverge in their words, by systolic rotation.

Per language, the terms that stand in at least `least` of its documents are kept and dealt into shards of about `SHARD` terms.
The sources of a language sit in blocks of `BLOCK`; a (language, shard, block) is a resident row with one compressed count
vector for each of its sources. Residents stay in their partition while the rounds of a round-robin tournament bring every
other block of the same language and shard by once: in a round the blocks pair off, one of each pair visits the other, and
only the visitors' vectors move. A meeting tells both directions of each pair of sources. Sums over shards meet at the end.
The terms that a source overuses come from a heap of each resident, since a resident also knows its language's totals.

Memory is bounded by a block's vectors of a shard, whatever the size of a source: a hot source is one vector among others,
made from counts that were summed before the shuffle. Every `TURNS` turns, their sums are written to the shared folder.

p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)) is a long division in digits of base 1000, exact up to N + 2 * V of
9 * 10**15 (else an error). f = floor((p - q)**2 / (p + q)) stays within 64 bits.

Null text, lang and source count as ''. Each row is a document, also one whose id repeats or is null. A group without kept
terms has count 0 for all of them; a language without kept terms has pair values of 0 and no term rows. Ties go by the
item's UTF-8 bytes. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable, ship, text_chunks
from .runs import LOWER, coded, members, pieces, runs_of

SHARD, BLOCK, SALT, LEAST, TOP = 1 << 13, 8, 64, 10, 10
SCALE = 10**9
#: Turns of the tournament that are run and written at a time.
TURNS = 16
#: Bytes of text whose counts are summed before they leave a task.
CHUNK = 1 << 22
TERM_BYTES = members((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_RESIDENT = "lang string, shard int, block int, blocks int, kept long, sources array<string>, totals array<long>, sizes array<int>, vectors binary, heads array<struct<source:string,item:string,value:long>>"


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    below = int(total) + 2 * int(kept)
    if below > 9 * 10**15:
        raise OverflowError("a source has more than 9 * 10**15 words")
    rest, out = np.asarray(count, np.int64) + 2, np.zeros(np.shape(count), np.int64)
    whole, rest = np.divmod(rest, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return 1 + out + whole * SCALE


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q))"""
    return (p - q) ** 2 // (p + q)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); partial sums, to be summed over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text", CHUNK):
                data = LOWER[data]
                starts, ends, doc = runs_of(data, offsets, TERM_BYTES)
                code, terms = coded(data, starts, ends)
                if not len(code):
                    continue
                of_doc, groups = pd.factorize(pd.MultiIndex.from_arrays([part.column("lang").to_pandas(), part.column("source").to_pandas()]))
                held, n = np.unique(doc * len(terms) + code, return_counts=True)
                key = of_doc[held // len(terms)] * len(terms) + held % len(terms)
                keys, place, docs_of = np.unique(key, return_inverse=True, return_counts=True)
                sums = np.zeros(len(keys), np.int64)
                np.add.at(sums, place, n)
                langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
                of_group, of_term = pa.array(keys // len(terms)), pa.array(keys % len(terms))
                yield from pieces(pa.RecordBatch.from_arrays([langs.take(of_group), sources.take(of_group), terms.take(of_term).cast(pa.string()), pa.array(sums), pa.array(docs_of)], ["lang", "source", "term", "n", "docs"]))

    return docs.mapInArrow(work, "lang string, source string, term string, n long, docs long")


def _packed(kept: DataFrame) -> DataFrame:
    """One row for each (lang, shard, block) with its sources' vectors and the head of each source's terms."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["source", "place"], kind="stable")
        one = rows.iloc[0]
        sources, totals, sizes, body, heads = [], [], [], [], []
        for source, of in rows.groupby("source", sort=True):
            held = of[of["n"] > 0]
            n, total = held["n"].to_numpy(np.int64), int(of["total"].iloc[0])
            sources.append(source)
            totals.append(total)
            sizes.append(len(n))
            body += [held["place"].to_numpy(np.int32), n]
            if len(n):
                p, q = share(n, total, one["kept"]), share(held["lang_n"].to_numpy(np.int64), one["lang_total"], one["kept"])
                over = np.flatnonzero(p > q)
                value, terms = gap(p, q)[over], held["term"].to_numpy()[over]
                if len(value) > TOP:
                    near = value >= np.partition(value, -TOP)[-TOP]
                    value, terms = value[near], terms[near]
                best = heapq.nsmallest(TOP, zip((-value).tolist(), (t.encode() for t in terms), strict=True))
                heads += [{"source": source, "item": t.decode(), "value": -v} for v, t in best]
        blob = zlib.compress(b"".join([x.tobytes() for x in body[0::2]] + [x.tobytes() for x in body[1::2]]), 1)
        return pd.DataFrame({"lang": [one["lang"]], "shard": [one["shard"]], "block": [one["block"]], "blocks": [one["blocks"]], "kept": [one["kept"]], "sources": [sources], "totals": [totals], "sizes": [sizes], "vectors": [blob], "heads": [heads]})

    return kept.groupBy("lang", "shard", "block").applyInPandas(pack, _RESIDENT)


class Vectors:
    """The vectors of a resident or a visitor: for each source the terms' places and the p of them, and the p of all others."""

    def __init__(self, sources: list[str], totals: list[int], sizes: list[int], blob: bytes, kept: int):
        body, n = zlib.decompress(blob), sum(sizes)
        ends = np.cumsum(sizes)[:-1]
        self.sources = sources
        self.places = np.split(np.frombuffer(body, np.int32, n), ends)
        counts = np.split(np.frombuffer(body, np.int64, n, n * 4), ends)
        self.p = [share(c, t, kept) if kept else c for c, t in zip(counts, totals, strict=True)]
        self.rest = [int(share(np.int64(0), t, kept)) if kept else 0 for t in totals]


def meeting(host: Vectors, guest: Vectors, terms: int) -> list[tuple[str, str, int]]:
    """Both directions of every pair of a host's and a guest's source: source, item, value over the shard's terms."""
    out = []
    if not terms:
        return [pair for a in host.sources for b in guest.sources if a != b for pair in ((a, b, 0), (b, a, 0))]
    for a, at, p, p0 in zip(host.sources, host.places, host.p, host.rest, strict=True):
        dense = np.full(terms, p0, np.int64)
        dense[at] = p
        for b, bt, q, q0 in zip(guest.sources, guest.places, guest.p, guest.rest, strict=True):
            if a == b:
                continue
            # all terms as if b held none of them, then those that it holds
            alone = int(gap(p, np.int64(q0)).sum()) + (terms - len(at)) * int(gap(np.int64(p0), np.int64(q0)))
            here = dense[bt]
            value = alone + int((gap(here, q) - gap(here, np.int64(q0))).sum())
            out += [(a, b, value), (b, a, value)]
    return out


def _meet(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a host and, unless it meets itself, a guest; partial sums of pairs."""
    for batch in rows:
        for r in batch.to_pylist():
            host = Vectors(r["sources"], r["totals"], r["sizes"], r["vectors"], r["kept"])
            own = r["guest_sources"] is None
            guest = host if own else Vectors(r["guest_sources"], r["guest_totals"], r["guest_sizes"], r["guest_vectors"], r["kept"])
            pairs = meeting(host, guest, r["terms"])
            if own:  # a block that meets itself tells each pair from both sides
                pairs = pairs[0::2]
            yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(pairs), pa.string()), pa.array([x[0] for x in pairs], pa.string()), pa.array([x[1] for x in pairs], pa.string()), pa.array([x[2] for x in pairs], pa.int64())], ["lang", "source", "item", "value"])


def _seats(turn: int) -> tuple:
    """The block that a row's block meets in a turn from 0 (null: none), and whether the row travels; all turns make each pair meet once."""
    i, even = F.col("block"), F.col("blocks") + F.col("blocks") % 2
    last = even - 1
    j = F.when(F.lit(turn) >= last, None).when(i == last, F.lit(turn)).when(i == turn, last).otherwise(F.pmod(2 * turn - i, last))
    j = F.when(j < F.col("blocks"), j)
    return j, (i > j) == ((i + j) % 2 == 1)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: see the module's text."""
    spark = docs.sparkSession
    ship(spark)
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    slim = docs.select(text("text"), text("lang"), text("source"))
    counts = Durable(term_counts(slim).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    every = Durable(slim.select("lang", "source").distinct(), "groups")
    terms = Durable(counts.df.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs"), "terms")
    langs = every.df.select("lang").distinct().join(terms.df.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left").na.fill(0)
    langs = langs.withColumn("shards", F.greatest(F.ceil(F.col("kept") / SHARD), F.lit(1)).cast("int"))
    # a language's terms are dealt by a salt too: one language may hold most of them
    salted = langs.select("lang", "shards", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    indexed = terms.df.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALT)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")
    indexed = indexed.withColumn("shard", F.pmod(F.xxhash64("term", F.lit(1)), F.col("shards")).cast("int"))
    indexed = indexed.withColumn("place", F.row_number().over(W.partitionBy("lang", "shard").orderBy("term")) - 1).drop("shards")
    index = Durable(indexed, "term-index")
    held = Durable(counts.df.select("lang", "source", "term", "n").join(index.df, ["lang", "term"]), "kept-counts")
    counts.drop()
    totals = held.df.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seat = (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("seat")
    size = F.count("*").over(W.partitionBy("lang")).alias("members")
    groups = every.df.select("lang", "source", seat, size).join(totals, ["lang", "source"], "left").na.fill(0).join(langs, "lang")
    groups = Durable(groups.select("lang", "source", F.floor(F.col("seat") / BLOCK).cast("int").alias("block"), F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"), "total", "kept", "lang_total", "shards"), "seats")
    present = groups.df.select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")).drop("shards")
    rows = present.join(held.df, ["lang", "source", "shard"], "left")
    packed = _packed(rows.select("lang", "shard", "block", "blocks", "kept", "lang_total", "source", "total", "term", F.coalesce("place", F.lit(0)).alias("place"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("lang_n", F.lit(0)).alias("lang_n")))
    residents = Durable(packed, "residents")
    for done in (held, every, terms):
        done.drop()
    sums = _tournament(residents, index)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))
    heads = residents.df.select("lang", F.inline("heads")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns("pair")).unionByName(heads.select(*columns("term")))


def _tournament(residents: Durable, index: Durable) -> DataFrame:
    """All meetings: residents are dealt once by their key and stay; a turn's visitors are dealt to where their hosts sit."""
    spark, key = residents.spark, ["lang", "shard", "block"]
    terms = index.df.groupBy("lang", "shard").agg(F.count("*").alias("terms"))
    home = residents.df.drop("heads").join(terms, ["lang", "shard"], "left").na.fill(0, ["terms"])
    blocks = residents.df.agg(F.max("blocks")).first()[0] or 0
    home = home.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *key).persist(StorageLevel.MEMORY_AND_DISK)
    carried = ["sources", "totals", "sizes", "vectors"]
    schema, sums, found = "lang string, source string, item string, value long", [], None
    own = home.select("*", *[F.lit(None).cast(residents.df.schema[c].dataType).alias(f"guest_{c}") for c in carried])
    last = blocks + blocks % 2 - 1
    try:
        for turn in range(-1, max(last, 0)):  # before the first turn every block meets itself
            host, travels = _seats(turn)
            guests = home.where(travels).select("lang", "shard", host.cast("int").alias("block"), *[F.col(c).alias(f"guest_{c}") for c in carried])
            met = (own if turn < 0 else home.join(guests, key)).mapInArrow(_meet, schema)
            found = met if found is None else found.unionByName(met)
            if turn % TURNS == TURNS - 1 or turn >= last - 1:  # what some turns told is summed over shards and written
                sums.append(Durable(found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "meetings"))
                found = None
    finally:
        home.unpersist()
    return spark.read.schema(schema).parquet(*[t.path for t in sums])
