"""Exact top-k by integer inner product with MaxScore over shards of posting lists.

Components are the terms, the whole numbers floor(64 x) their weights. The postings are a table of their own: for each shard
and term the entries that have it with their weights, and the largest and the least of these, which bound what the term
can add to a query's score (a list of over a share `DENSE` of its shard's entries keeps a weight for each entry instead). For a query, terms are ordered
by bound; weak terms whose bounds together stay below a share `SLACK` of the threshold (the k-th best score so far) are
non-essential. The posting lists of the essential terms are traversed, run by run of entries, for a batch of queries at a
time; a list that no query of the batch finds essential is not read. An entry whose score so far and the bounds of what is
left don't reach the threshold is given up; for the others the non-essential terms are probed, the stronger half first.
Thresholds rise from run to run. Shards and blocks of queries meet as tiles of bounded size; the tiles' best are merged.
Every entry is considered, none is dropped without a bound.

Vectors that are null, empty or hold null or non-finite components take no part; nor do rows without an id. Zero vectors
do. Shorter vectors count as ending in zeros. vec_id is taken as a key: rows that share one are not compared. Equal scores
go to the smaller vec_id. An empty table gives an empty table. Scores must stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable
from .vectors import QUERY_BLOCK, Best, blocks, finite, is_query, matrix, merge, salted

SCALE, SHARD = 64.0, 16_384
#: Entries of the first run, which sets thresholds, and of later ones; queries of a batch; entries probed at a time.
FIRST_RUN, RUN, BATCH, PROBE = 1024, 4096, 256, 1 << 16
#: The share of the threshold that non-essential terms may reach together. Any share up to 1 gives exact results; with a
#: small one, fewer entries are left to probe.
SLACK = 0.25
DENSE = 0.25


@dataclass
class Postings:
    """One shard: ids of its entries, and for each term entries and weights, of which `full` ones have a weight for every entry."""

    ids: np.ndarray
    full_terms: np.ndarray
    full: np.ndarray  # term x entry
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def read(cls, d: int, ids: np.ndarray, rows: pd.DataFrame, kind: np.dtype) -> Postings:
        """rows: term, entries (empty bytes: all), weights, low, high."""
        low, high, lists, terms, full = np.zeros(d), np.zeros(d), {}, [], []
        for r in rows.itertuples():
            weights = np.frombuffer(r.weights, kind)
            low[r.term], high[r.term] = r.low, r.high
            if len(weights) == len(ids):
                terms.append(r.term)
                full.append(weights)
            else:
                lists[r.term] = np.frombuffer(r.entries, "<i4"), weights
        return cls(ids, np.array(terms, int), np.array(full, float).reshape(len(terms), len(ids)), lists, low, high)


def posting_rows(x: np.ndarray, kind: np.dtype) -> list[tuple[int, bytes, bytes, float, float]]:
    """x: entry x term. term, entries, weights and their bounds of every term that some entry has."""
    out = []
    for t in range(x.shape[1]):
        at = np.flatnonzero(x[:, t])
        if len(at):
            dense = len(at) > DENSE * len(x)
            w = x[:, t] if dense else x[at, t]
            low, high = (w.min(), w.max()) if dense else (min(w.min(), 0.0), max(w.max(), 0.0))  # an entry without the term adds nothing
            out.append((t, b"" if dense else at.astype("<i4").tobytes(), w.astype(kind).tobytes(), low, high))
    return out


def top(queries: np.ndarray, query_ids: np.ndarray, shard: Postings, k: int, run: int = RUN, first_run: int = FIRST_RUN, slack: float = SLACK) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each query the ids and scores of its k best entries in the shard."""
    n, d = len(shard.ids), queries.shape[1]
    found: tuple[list[np.ndarray], list[np.ndarray]] = [], []
    if not n or not len(queries):
        return found
    peak = (np.abs(queries).max(axis=0) * np.maximum(np.abs(shard.low), np.abs(shard.high))).sum()
    number = np.float32 if peak < 1 << 24 else np.float64  # both hold all sums exactly
    full = shard.full.astype(number)
    by_entry = np.zeros((n, d), number)  # for probing
    by_entry[:, shard.full_terms] = full.T
    sparse = {t: (at, w.astype(number)) for t, (at, w) in shard.lists.items()}
    for t, (at, w) in sparse.items():
        by_entry[at, t] = w
    edges = [0, *range(min(n, first_run), n, run), n]
    for b in range(0, len(queries), BATCH):
        asked, own, best = queries[b : b + BATCH].astype(number), query_ids[b : b + BATCH], Best(len(queries[b : b + BATCH]), k)
        bounds = np.maximum(asked * shard.high, asked * shard.low)
        order = np.argsort(bounds, axis=1, kind="stable")  # weakest terms first
        reach = np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)
        for s, e in zip(edges, edges[1:], strict=False):
            weak = np.zeros(asked.shape, bool)
            np.put_along_axis(weak, order, reach < (slack * best.threshold)[:, None], 1)
            rest = np.where(weak, bounds, 0.0).sum(axis=1)
            essential = np.where(weak, number(0), asked)
            read = np.flatnonzero((~weak).any(axis=0)[shard.full_terms])
            partial = essential[:, shard.full_terms[read]] @ full[read, s:e]
            for t, (at, w) in sparse.items():
                asking = np.flatnonzero(essential[:, t])
                lo, hi = np.searchsorted(at, (s, e))
                if len(asking) and hi > lo:
                    partial[asking[:, None], at[lo:hi] - s] += essential[asking, t][:, None] * w[lo:hi]
            if s == 0:  # no thresholds yet: the k best of each query and whatever ties with them
                m = min(k + 1, e - s)  # the query itself may be among them
                alive = partial >= np.partition(partial, e - s - m, axis=1)[:, e - s - m][:, None]
            else:
                alive = partial >= (best.threshold - rest)[:, None].astype(number)
            row, entry = np.nonzero(alive)
            half = np.zeros_like(weak)
            np.put_along_axis(half, order, np.arange(d) >= (weak.sum(axis=1) // 2)[:, None], 1)
            for p in range(0, len(row), PROBE):
                i, j = row[p : p + PROBE], entry[p : p + PROBE]
                other = own[i] != shard.ids[s + j]
                i, j = i[other], j[other]
                score, left = partial[i, j].astype(float), rest[i]
                for terms in (weak & half, weak & ~half):
                    if not terms.any() or not len(i):
                        continue
                    score = score + np.einsum("ij,ij->i", np.where(terms, asked, number(0))[i], by_entry[s + j])
                    left = left - np.where(terms, bounds, 0.0).sum(axis=1)[i]
                    keep = score + left >= best.threshold[i]
                    i, j, score, left = i[keep], j[keep], score[keep], left[keep]
                best.add(i, shard.ids[s + j], score)
        for all_, part in zip(found, best.lists(), strict=True):
            all_.extend(part)
    return found


def search(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest whole-number inner products of each query (ids divisible by `every`)."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    rows = rows.where(finite(F.col("v")))
    peak = F.array_max(F.transform("v", lambda x: F.abs(F.floor(x * F.lit(scale)).cast("double"))))
    size = rows.agg(F.count("*").alias("n"), F.sum(is_query(F.col("vec_id"), every).cast("long")).alias("q"), F.max(F.size("v")).alias("d"), F.max(peak).alias("peak")).first()
    if not size["n"] or not size["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    d, n_blocks = size["d"], blocks(size["q"], QUERY_BLOCK)
    shards = blocks(size["n"], SHARD)
    kind = np.dtype("<i2") if size["peak"] < 1 << 15 else np.dtype("<i4") if size["peak"] < 1 << 31 else np.dtype("<f8")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = np.floor(matrix(lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()), d) * scale).astype(kind)
            raw = x.tobytes()
            width = d * kind.itemsize
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[k : k + width] for k in range(0, len(raw), width)], pa.binary())], ["vec_id", "v"])

    index = Durable(rows.mapInArrow(weigh, "vec_id long, v binary"), "weights").df
    stored = "shard int, term int, entries binary, weights binary, low double, high double"

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        """The postings of one shard, and its entries' ids under term -1."""
        frame = frame.sort_values("vec_id")
        x = np.frombuffer(b"".join(frame["v"]), kind).reshape(-1, d).astype(float)
        rows = [(-1, frame["vec_id"].to_numpy().astype("<i8").tobytes(), b"", 0.0, 0.0), *posting_rows(x, kind)]
        return pd.DataFrame([(int(frame["shard"].iloc[0]), *r) for r in rows], columns=["shard", "term", "entries", "weights", "low", "high"])

    postings = Durable(index.withColumn("shard", salted(F.col("vec_id"), shards)).groupBy("shard").applyInPandas(build, stored), "postings").df
    postings = postings.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    queries = index.where(is_query(F.col("vec_id"), every)).withColumn("block", salted(F.col("vec_id"), n_blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def work(query: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(query) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_ids": [], "scores": []})
        is_ids = rows["term"] == -1
        shard = Postings.read(d, np.frombuffer(rows[is_ids]["entries"].iloc[0], "<i8"), rows[~is_ids], kind)
        x = np.frombuffer(b"".join(query["v"]), kind).reshape(-1, d).astype(float)
        ids, scores = top(x, query["vec_id"].to_numpy(), shard, k)
        return pd.DataFrame({"query_id": query["vec_id"], "vec_ids": [a.tolist() for a in ids], "scores": [b.astype(np.int64).tolist() for b in scores]})

    key = ["shard", "block"]
    tiles = queries.groupBy(*key).cogroup(postings.groupBy(*key)).applyInPandas(work, "query_id long, vec_ids array<bigint>, scores array<bigint>")
    return merge(tiles, k, "long")
