"""Near-duplicates by word shingles: SimHash candidates and, beyond its radius, buckets; every link is verified exactly.

Words are as in `simhash`; a text's shingles are its distinct word 5-grams (the whole sequence if shorter), told by 64-bit
hashes. Two texts are linked if the Jaccard similarity of their shingles is 0.8 or more; a group is a component of links.
Texts of equal shingles stand for one; all texts without a word, null ones too, are equal.

Candidates come first from the Gray-order index of `simhash` over the fingerprints of the 5-grams. Texts at similarity 0.8
differ in some 10 of 64 bits, out of reach of any such index, so minima of the shingles' hashes make `BANDS` keys of `ROWS`
each: a pair at similarity 0.8 shares none with probability 0.00007, more alike pairs with less. Buckets of equal keys are
held against each other in turns: in the first ones every member of a bucket is held against one leader, so a crowd of near
copies mostly becomes one group by as many pairs as it has members. What these turns leave in different groups of one bucket
is searched by prefix filtering: a set's shingles are ordered by how many of these sets hold them, rarest first; two sets
of n <= m shingles at similarity 0.8 share one of the first n / 9 + 1 and m / 5 + 1, so texts that only share a passage don't
meet, as its shingles are frequent and come last. Those that meet are told apart by bitmaps of `PARITY` bits (whether an even
or odd number of a set's shingles falls on each bit), which differ in no more bits than the sets have shingles of their own.
These filters lose no linked pair. Crowds of texts just below 0.8 still meet each other within a shingle's group there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Durable, text_chunks, unlike
from .components import components
from .simhash import links as simhash_links
from .simhash import majority
from .words import packed, words_of

SHINGLE, SEED, BANDS, ROWS, STAR_TURNS, PARITY = 5, 42, 24, 5, 2, 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles (repeats too), and for each text its first one's place (one more entry at the end)."""
    n = len(offsets) - 1
    starts, ends, word_of = words_of(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    joined, places = packed(_LOWER[data], starts, ends)
    raw = joined.tobytes()
    count = np.diff(word_of)
    grams = np.where(count == 0, 0, np.maximum(count - SHINGLE + 1, 1))
    upto = np.concatenate([[0], np.cumsum(grams)])
    begin = np.repeat(word_of[:-1] - upto[:-1], grams) + np.arange(upto[-1])
    end = np.minimum(begin + SHINGLE, np.repeat(word_of[1:], grams))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(raw[s:e], SEED) for s, e in zip(places[begin].tolist(), (places[end] - 1).tolist(), strict=True)), np.uint64, int(upto[-1])), upto


def distinct_of(hashes: np.ndarray, upto: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[s:e]) for s, e in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


def names_of(sets: list[np.ndarray]) -> np.ndarray:
    """One number for each set of shingles."""
    return np.fromiter((xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets), np.uint64, len(sets)).view(np.int64)


def bands_of(hashes: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Bucket keys (text x band) of texts that have a shingle."""
    out = np.zeros((len(upto) - 1, BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(upto) - 1, np.uint64(band + 1))
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = (key ^ np.minimum.reduceat(hashes * _MULTIPLIERS[k], upto[:-1])) * _MIX
            key ^= key >> np.uint64(32)
        out[:, band] = key
    return out.view(np.int64)


def _signed(rows: DataFrame) -> DataFrame:
    """rows: doc_id, row, text. doc_id, row, s (the name of its shingles), fp (their fingerprint), bands (empty if it has none)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                hashes, upto = shingles_of(data, offsets)
                some = np.diff(upto) > 0
                keys = bands_of(hashes, np.concatenate([upto[:-1][some], upto[-1:]])) if some.any() else np.zeros((0, BANDS), np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names_of(distinct_of(hashes, upto))), pa.array(majority(hashes, upto).view(np.int64)), bands], ["doc_id", "row", "s", "fp", "bands"])

    return rows.mapInArrow(work, "doc_id long, row long, s long, fp long, bands array<long>")


def parity_of(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (row) the parity of its shingles on each of `PARITY` bits, as longs."""
    odd = np.zeros((len(sets), PARITY), np.uint8)
    for k, s in enumerate(sets):
        odd[k] = np.bincount((s % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def _sets(rows: DataFrame) -> DataFrame:
    """rows: text. s, n, parity, shingles (n distinct hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_chunks(batch, "text"):
                sets = distinct_of(*shingles_of(data, offsets))
                sizes = np.array([len(s) for s in sets], np.int64)
                upto = np.concatenate([[0], np.cumsum(sizes)])
                parity = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (PARITY // 64), pa.int32()), pa.array(parity_of(sets).ravel()))
                shingles = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(names_of(sets)), pa.array(sizes), parity, shingles], ["s", "n", "parity", "shingles"])

    return rows.mapInArrow(work, "s long, n long, parity array<long>, shingles array<long>")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with similarity 0.8 or more: common / (all - common) >= 4 / 5."""
    size = sets.select("s", "n")
    near = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where("5 * least(na, nb) >= 4 * greatest(na, nb)")
    both = near.join(sets.select("s", "shingles").toDF("a", "sa"), "a").join(sets.select("s", "shingles").toDF("b", "sb"), "b")
    return both.where(F.size(F.array_intersect("sa", "sb")) * 9 >= (F.col("na") + F.col("nb")) * 4).select("a", "b")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _prefix_pairs(left: DataFrame, sets: DataFrame) -> DataFrame:
    """left: s, c (its group). Pairs (a, b) of different groups, among them all at similarity 0.8."""
    held = Durable(left.join(sets, "s").select("s", "c", "n", F.explode("shingles").alias("t")), "open-shingles").df
    shared = held.groupBy("t").agg(F.count("*").alias("f")).where("f > 1")
    of_set = Window.partitionBy("s")
    # the shingles of one set alone come first and meet nobody: they only take places
    placed = held.join(shared, "t").withColumn("alone", F.col("n") - F.count("*").over(of_set)).where("alone <= n div 5")
    place = (F.col("alone") + F.row_number().over(of_set.orderBy("f", "t"))).alias("at")
    prefix = Durable(placed.select("t", "s", "c", "n", place).where("at <= n div 5 + 1").join(sets.select("s", "parity"), "s"), "prefixes").df
    mixed = prefix.groupBy("t").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").select("t")
    met = Durable(prefix.join(mixed, "t", "left_semi").select("t", "s", "c", "n", "at", "parity"), "prefixes").df
    unlike_bits = " + ".join(f"bit_count(parity[{k}] ^ parity2[{k}])" for k in range(PARITY // 64))
    near = met.where("at <= n div 9 + 1").join(met.toDF("t", "s2", "c2", "n2", "at2", "parity2"), "t").where(
        "c <> c2 AND (n < n2 OR n = n2 AND s < s2) AND 5 * n >= 4 * n2"
        f" AND 9 * (1 + least(n - at, n2 - at2)) >= 4 * (n + n2) AND 9 * ({unlike_bits}) <= n + n2"
    )
    return near.select(*_pair("s", "s2"))


def _gray(firsts: DataFrame) -> DataFrame:
    """Pairs (a, b) that the Gray-order index links: of equal fingerprints with one of them, and of near fingerprints."""
    some = firsts.where(F.size("bands") > 0)
    distinct = Durable(some.groupBy("fp").agg(F.min("s").alias("node")), "shingle-fingerprints").df
    equal = some.join(distinct, "fp").where("s <> node").select(*_pair("s", "node"))
    return equal.unionByName(simhash_links(distinct)).distinct()


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, that have the least doc_id of their group; where that id repeats, the row of the
    least hash over its columns (equal rows count as one). Null ids stay."""
    row_hash, kept_id, kept_row = (unlike(x, docs.columns) for x in ("row_hash", "kept_id", "kept_row"))
    named = docs.where("doc_id IS NOT NULL").withColumn(row_hash, F.xxhash64(*docs.columns))
    slim = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row_hash).alias("row"), F.col("text").cast("string").alias("text"))
    # equal shingles are brought together before anything is dealt out, so crowds of copies are no hot spot
    firsts = Durable(_signed(slim).groupBy("s").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.min("fp").alias("fp"), F.min("bands").alias("bands")), "shingle-sets").df
    buckets = firsts.select("s", F.explode("bands").alias("g"))
    crowded = buckets.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    members = Durable(buckets.join(crowded, "g").select("g", "s"), "buckets").df
    near = Durable(_gray(firsts), "candidates").df
    asked = members.select("s").unionByName(near.select(F.explode(F.array("a", "b")).alias("s"))).distinct()
    chosen = firsts.join(asked, "s", "left_semi").select("first.doc_id", "first.row")
    sets = Durable(_sets(slim.join(chosen, ["doc_id", "row"], "left_semi").dropDuplicates(["doc_id", "row"]).select("text")), "shingles").df
    held, links = near, Durable(_alike(near, sets), "links").df
    label = components(links)
    for turn in range(STAR_TURNS + 1):
        at = members.join(label, F.col("s") == F.col("node"), "left").select("g", "s", F.coalesce("component", "s").alias("c"))
        leaders = at.groupBy("g").agg(F.min(F.struct(F.xxhash64("s", "g", F.lit(turn)).alias("h"), "s", "c")).alias("leader"), F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most")
        if turn < STAR_TURNS:
            open_ = at.join(leaders, "g").where("c <> leader.c").select(*_pair("s", "leader.s"))
        else:
            open_ = _prefix_pairs(at.join(leaders.select("g"), "g", "left_semi").select("s", "c").distinct(), sets)
        pairs = Durable(open_.distinct().join(held, ["a", "b"], "left_anti"), "candidates").df
        if turn == STAR_TURNS and pairs.isEmpty():
            break
        held = held.unionByName(pairs)
        links = links.unionByName(Durable(_alike(pairs, sets), "links").df)
        label = components(links)
    group = firsts.join(label, F.col("s") == F.col("node"), "left").groupBy(F.coalesce("component", "s").alias("c")).agg(F.min("first").alias("first"))
    kept = named.join(group.select(F.col("first.doc_id").alias(kept_id), F.col("first.row").alias(kept_row)), (F.col("doc_id") == F.col(kept_id)) & (F.col(row_hash) == F.col(kept_row)), "left_semi")
    return kept.dropDuplicates(["doc_id", row_hash]).select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
