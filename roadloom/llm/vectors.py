"""Vectors as rows and matrices, best lists in numpy, and merging of the tiles' best.

A tile joins one shard of entries with one block of queries, both of bounded size, as a cogroup of its own. Each query of a
tile yields one row with its best entries there; the best of all tiles are merged by a window over the query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 8192


def is_query(vec_id: Column, every: int = 20) -> Column:
    return vec_id % every == 0


def finite(vector: Column) -> Column:
    """True where no component is null, NaN or infinite, and there is one at least."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def blocks(rows: int, block: int) -> int:
    return max(1, -(-rows // block))


def salted(key: Column, n: Column | int) -> Column:
    """A number from 0 below n that follows from the key."""
    return F.pmod(F.xxhash64(key, F.lit(11)), F.lit(n) if isinstance(n, int) else n).cast("int")


def matrix(values: np.ndarray, lengths: np.ndarray, d: int) -> np.ndarray:
    """Rows of d numbers from vectors that lie end to end; shorter vectors count as ending in zeros."""
    out = np.zeros((len(lengths), d))
    out[np.arange(d) < lengths[:, None]] = values
    return out


class Best:
    """The k best (score, id) of each of n queries, larger scores and then smaller ids first."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.threshold = np.full(n, -np.inf)  # the k-th best score, once there are k

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        q, i, s = np.concatenate([self.query, query]), np.concatenate([self.id, ids]), np.concatenate([self.score, score])
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        starts = np.searchsorted(q, np.arange(self.n))
        rank = np.arange(len(q)) - starts[q]
        keep = rank < self.k
        last = rank == self.k - 1
        self.threshold[q[last]] = s[last]
        self.query, self.id, self.score = q[keep], i[keep], s[keep]

    def lists(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        cuts = np.searchsorted(self.query, np.arange(1, self.n))
        return np.split(self.id, cuts), np.split(self.score, cuts)


def merge(tiles: DataFrame, k: int, score: str) -> DataFrame:
    """tiles: query_id, vec_ids, scores. The k best of each query: query_id, rank, vec_id, score."""
    one = tiles.select("query_id", F.inline(F.arrays_zip(F.col("vec_ids").alias("vec_id"), F.col("scores").alias("score"))))
    one = one.toDF("query_id", "vec_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").cast(score).alias("score"))
