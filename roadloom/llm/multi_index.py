"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Both halves of the vectors are quantised on their own by centroids learned from a bounded sample of `SAMPLE` vectors, about
as many that a cell holds `CELL` entries (`CENTROIDS` at most); every vector is indexed in the cell of its two nearest
centroids. A query walks the centroid pairs by falling sum of what its halves can expect from the centroids: the inner
product, and for the entries' spread round a centroid a few standard deviations of it. A heap over the sorted lists gives
the next pair. The walk stops when the cells passed hold a share of all entries, and these are ranked by the exact product.

The share is measured on the table at hand: for `PROBES` of its queries the true neighbours are found among all entries,
and the share is the one within which a part `AIM` of them lies. Vectors in clusters need little of it; on vectors spread
evenly over a sphere of many dimensions no index prunes much, and it comes near a half.

Cells of one first centroid stay together in shards of about `SHARD` entries, several small ones in one shard; a crowded
one is cut by a hash. A query goes only to the shards in which it wants a cell.

Vectors that are null, empty, zero, or that hold null or non-finite components take no part; nor do rows without an id.
Shorter vectors count as ending in zeros. vec_id is taken as a key: rows that share one are not compared. Equal products go
to the smaller vec_id. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable
from .vectors import QUERY_BLOCK, Best, blocks, finite, is_query, matrix, merge, salted

CENTROIDS, CELL, SAMPLE, PROBES, AIM, SHARD = 256, 50, 8192, 128, 0.95, 16_384
#: Standard deviations of an entry's distance from its centroid, along a query, that a cell is credited with.
SPREAD = 3.0
#: Queries of a batch, and entries that are ranked at a time.
BATCH, RUN = 256, 4096


def k_means(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """At most k centroids, and the root mean square of each one's distance from its vectors over the root of the
    dimensions; the start is spread evenly over the sample's rows."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    near = nearest(x, c)
    square = np.bincount(near, ((x - c[near]) ** 2).sum(axis=1), minlength=len(c)) / np.maximum(1, np.bincount(near, minlength=len(c)))
    return c, np.sqrt(square / max(1, x.shape[1]))


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - (c * c).sum(axis=1) / 2, axis=1)


def walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, want: float) -> Iterator[tuple[int, int]]:
    """Pairs of places by falling first[i] + second[j] until their cells hold `want` entries. A row of the pairs enters the
    heap once the row before it has shown its best."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    f, s, counts = (-first[a]).tolist(), (-second[b]).tolist(), held[np.ix_(a, b)].tolist()
    heap, total, width = [(f[0] + s[0], 0, 0)], 0, len(b)
    while heap and total < want:
        _, i, j = heap[0]
        if counts[i][j]:
            yield a[i], b[j]
            total += counts[i][j]
        if j + 1 < width:
            heapq.heapreplace(heap, (f[i] + s[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (f[i + 1] + s[0], i + 1, 0))


class Cells:
    """Centroids of both halves, and what a query expects of them."""

    def __init__(self, sample: np.ndarray, centroids: int):
        self.half = max(1, sample.shape[1] // 2)
        self.parts = [k_means(sample[:, : self.half], centroids)]
        self.parts.append(k_means(sample[:, self.half :], centroids) if sample.shape[1] > 1 else (np.zeros((1, 0)), np.zeros(1)))

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.parts[0][0]), nearest(x[:, self.half :], self.parts[1][0])

    def expect(self, q: np.ndarray) -> list[np.ndarray]:
        return [c @ x + SPREAD * spread * np.sqrt(x @ x) for (c, spread), x in zip(self.parts, (q[: self.half], q[self.half :]), strict=True)]


def rank_in(x: np.ndarray, query_ids: np.ndarray, e: np.ndarray, ids: np.ndarray, k: int, wanted: np.ndarray | None = None, cell: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each query the k nearest entries. wanted (query x cell): which cells it may look into; cell: each entry's."""
    found: tuple[list[np.ndarray], list[np.ndarray]] = [], []
    e32 = e.astype(np.float32)
    reach = np.sqrt((e * e).sum(axis=1).max()) if len(e) else 0.0
    for b in range(0, len(x), BATCH):
        part, own, best = x[b : b + BATCH], query_ids[b : b + BATCH], Best(len(x[b : b + BATCH]), k)
        left, right = part.astype(np.float32), e32
        if not (np.isfinite(left).all() and np.isfinite(right).all()):
            left, right = part, e
        blur = 1e-5 * np.sqrt((part * part).sum(axis=1)) * reach  # more than single precision loses
        for s in range(0, len(e), RUN):
            near = left @ right[s : s + RUN].T
            if wanted is not None:
                near[~wanted[b : b + BATCH, cell[s : s + RUN]]] = -np.inf
            least = best.threshold - blur
            if s == 0:
                m = min(k + 1, near.shape[1])  # the query itself may be among them
                least = np.partition(near, near.shape[1] - m, axis=1)[:, near.shape[1] - m] - 2 * blur
            i, j = np.nonzero((near >= least[:, None]) & (near > -np.inf))
            other = own[i] != ids[s + j]
            i, j = i[other], s + j[other]
            for p in range(0, len(i), 1 << 16):
                r, t = i[p : p + (1 << 16)], j[p : p + (1 << 16)]
                best.add(r, ids[t], (part[r] * e[t]).sum(axis=1))  # one fixed order of addition for every pair
        for all_, some in zip(found, best.lists(), strict=True):
            all_.extend(some)
    return found


def _list_matrix(lists: pa.Array, d: int) -> np.ndarray:
    return matrix(lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()), d)


def search(vectors: DataFrame, k: int = 20, every: int = 20, aim: float = AIM, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each query (ids divisible by `every`)."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    rows = rows.where(finite(F.col("v")) & F.exists("v", lambda x: x != 0))
    size = rows.agg(F.count("*").alias("n"), F.sum(is_query(F.col("vec_id"), every).cast("long")).alias("q"), F.max(F.size("v")).alias("d")).first()
    if not size["n"] or not size["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, d = size["n"], size["d"]
    # the vectors with the smallest hashes: as many at every size, so a bounded sample
    sampled = rows.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    cells = Cells(_list_matrix(sampled, d), min(CENTROIDS, max(2, int(np.sqrt(n / CELL)))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _list_matrix(batch.column(1), d)
            one, two = cells.code(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(one, pa.int32()), pa.array(two, pa.int32())], ["vec_id", "v", "one", "two"])

    index = Durable(rows.mapInArrow(code, "vec_id long, v binary, one int, two int"), "multi-index").df
    held = np.zeros((len(cells.parts[0][0]), len(cells.parts[1][0])), np.int64)  # CENTROIDS x CENTROIDS numbers at most
    for r in index.groupBy("one", "two").count().collect():
        held[r["one"], r["two"]] = r["count"]
    queries = index.where(is_query(F.col("vec_id"), every)).select(F.col("vec_id").alias("query_id"), "v")
    want = _share(index, queries, cells, held, k, aim) * n

    # shards of first centroids: small ones side by side, a crowded one in parts
    group, parts, filled = np.zeros(len(held), int), [1], 0
    for one, count in enumerate(held.sum(axis=1).tolist()):
        if filled and filled + count > SHARD:
            parts.append(1)
            filled = 0
        group[one] = len(parts) - 1
        filled += count
        parts[-1] = max(1, -(-filled // SHARD))
    n_blocks = blocks(size["q"], QUERY_BLOCK)
    parts_of = spark.createDataFrame([(g, p) for g, p in enumerate(parts)], "group int, parts int")  # a row for each group of centroids
    group_of = spark.createDataFrame(list(enumerate(group.tolist())), "one int, group int")  # a row for each centroid

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for q, v in zip(frame["query_id"], frame["v"], strict=True):
                wanted = np.zeros(held.shape, bool)
                pairs = np.array(list(walk(*cells.expect(np.frombuffer(v)), held, want))).reshape(-1, 2)
                wanted[pairs[:, 0], pairs[:, 1]] = True
                for g in np.unique(group[pairs[:, 0]]).tolist():
                    out.append((q, v, g, np.packbits(wanted[group == g]).tobytes()))
            yield pd.DataFrame(out, columns=["query_id", "v", "group", "cells"])

    probes = queries.repartition("query_id").mapInPandas(route, "query_id long, v binary, group int, cells binary")
    probes = probes.join(F.broadcast(parts_of), "group").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("block", salted(F.col("query_id"), n_blocks)).drop("parts")
    entries = index.join(F.broadcast(group_of), "one").join(F.broadcast(parts_of), "group").withColumn("shard", salted(F.col("vec_id"), F.col("parts"))).drop("parts")
    entries = entries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def rank(probe: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(probe) or not len(entry):
            return pd.DataFrame({"query_id": [], "vec_ids": [], "scores": []})
        ones = np.flatnonzero(group == int(probe["group"].iloc[0]))
        wanted = np.unpackbits(np.frombuffer(b"".join(probe["cells"]), np.uint8).reshape(len(probe), -1), axis=1, count=len(ones) * held.shape[1]).astype(bool)
        cell = np.searchsorted(ones, entry["one"].to_numpy()) * held.shape[1] + entry["two"].to_numpy()
        order = np.argsort(cell, kind="stable")
        asked = wanted[:, cell[order]].any(axis=0)  # entries of cells that no query of the block wants are not read
        order = order[asked]
        e = np.frombuffer(b"".join(entry["v"])).reshape(-1, d)[order]
        x = np.frombuffer(b"".join(probe["v"])).reshape(-1, d)
        ids, scores = rank_in(x, probe["query_id"].to_numpy(), e, entry["vec_id"].to_numpy()[order], k, wanted, cell[order])
        return pd.DataFrame({"query_id": probe["query_id"], "vec_ids": [a.tolist() for a in ids], "scores": [b.tolist() for b in scores]})

    key = ["group", "shard", "block"]
    tiles = probes.groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(rank, "query_id long, vec_ids array<bigint>, scores array<double>")
    return merge(tiles, k, "double")


def _share(index: DataFrame, queries: DataFrame, cells: Cells, held: np.ndarray, k: int, aim: float) -> float:
    """The share of all entries within which a part `aim` of the true neighbours lies, for PROBES queries of the table."""
    probes = queries.orderBy(F.xxhash64("query_id", F.lit(9)), "query_id").limit(PROBES).collect()
    x, ids = np.stack([np.frombuffer(r["v"]) for r in probes]), np.array([r["query_id"] for r in probes])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The k nearest of each probe in a batch; vec_ids hold their cells' numbers beside them."""
        for frame in batches:
            cell = frame["one"].to_numpy() * held.shape[1] + frame["two"].to_numpy()
            entry = frame["vec_id"].to_numpy()
            near, scores = rank_in(x, ids, np.frombuffer(b"".join(frame["v"])).reshape(len(frame), -1), entry, k)
            order = np.argsort(entry, kind="stable")
            rows = [(int(q), int(i), float(s), int(cell[order[np.searchsorted(entry, i, sorter=order)]])) for q, a, b in zip(ids, near, scores, strict=True) for i, s in zip(a, b, strict=True)]
            yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score", "cell"])

    found = index.mapInPandas(exact, "query_id long, vec_id long, score double, cell int")
    top = found.groupBy("query_id").agg(F.expr(f"slice(array_sort(collect_list(struct(-score AS s, vec_id, cell))), 1, {int(k)})").alias("near"))  # k for each batch of the index at most
    n, reached = held.sum(), []
    cells_of = {r["query_id"]: [c["cell"] for c in r["near"]] for r in top.collect()}  # PROBES rows
    for q, v in zip(ids.tolist(), x, strict=True):
        passed, at = 0, {}
        for one, two in walk(*cells.expect(v), held, n):
            at[one * held.shape[1] + two] = passed  # the walk goes on to this cell if it wants more than that
            passed += held[one, two]
        reached += [(at[c] + 1) / n for c in cells_of.get(q, [])]
    return float(np.quantile(reached, aim)) if reached else 1.0
