"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: words are runs of visible characters after lower-casing A-Z, features the word 3-grams (the whole sequence
if shorter, repeats counted) hashed by XXH64 with seed 42; a bit is 1 if set in over half of them. No words: zero.

Linking, at `radius` or fewer differing bits, runs over distinct fingerprints. The bits are cut into radius + 1 fields;
two linked fingerprints agree in one of them, so fingerprints meet in groups of equal field values, whose widths follow
the number of fingerprints. A group over `GROUP_LIMIT` is cut again over its remaining bits in the same way until it is
small, which keeps the search exact. In a group, fingerprints are sorted by Gray rank and a tree is built over them: a node
keeps the bits on which all below agree and its parents do not have yet, so a search adds up differences on the way down
and leaves out whole subtrees once they exceed the radius. A group gives a spanning forest of its links, never all pairs.

Null and empty texts have fingerprint zero and link like any other. Repeated rows link to each other. Documents with a
null id are not linked (their component is null). An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable, text_chunks
from .components import components
from .words import packed, words_of

BITS, RADIUS, SEED, SHINGLE = 64, 2, 42, 3
#: Fingerprints that one group's index may hold, and the mean that field widths aim at.
GROUP_LIMIT, GROUP_MEAN = 20_000, 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One fingerprint for each text."""
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    if not len(data):
        return out
    starts, ends, word_of = words_of(data, offsets)
    if not len(starts):
        return out
    joined, places = packed(_LOWER[data], starts, ends)
    raw = joined.tobytes()
    count = np.diff(word_of)
    grams = np.where(count == 0, 0, np.maximum(count - shingle + 1, 1))
    upto = np.concatenate([[0], np.cumsum(grams)])
    begin = np.repeat(word_of[:-1] - upto[:-1], grams) + np.arange(upto[-1])
    end = np.minimum(begin + shingle, np.repeat(word_of[1:], grams))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(places[begin].tolist(), (places[end] - 1).tolist(), strict=True)), np.uint64, int(upto[-1]))
    return majority(hashes, upto)


def majority(hashes: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """One fingerprint for each text's range of hashes: the bits set in over half of them; zero where there are none."""
    grams = np.diff(upto)
    out = np.zeros(len(grams), np.uint64)
    some = np.flatnonzero(grams)
    for k in range(0, len(some), 256):  # the bit matrix of a few texts at a time
        rows = some[k : k + 256]
        s, e = upto[rows[0]], upto[rows[-1] + 1]
        votes = np.zeros((len(rows), BITS), np.int64)
        for t in range(s, e, 1 << 16):
            stop = min(e, t + (1 << 16))
            bits = np.unpackbits(hashes[t:stop].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            lo = np.searchsorted(upto[rows], t, "right") - 1
            hi = np.searchsorted(upto[rows], stop, "left")
            votes[lo:hi] += np.add.reduceat(bits, np.maximum(upto[rows[lo:hi]], t) - t, axis=0, dtype=np.int64)
        over = votes * 2 > grams[rows][:, None]
        out[rows] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints_of(data, offsets).view(np.int64))], ["doc_id", "fp"])

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(work, "doc_id long, fp long")


class GrayIndex:
    """A tree over distinct fingerprints in Gray order."""

    FAN = 8

    def __init__(self, values: np.ndarray):
        rank = values.copy()  # the place of a value in the Gray sequence
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        self.order = np.argsort(rank, kind="stable")
        level = values[self.order]
        same = np.full(len(level), np.uint64(0xFFFFFFFFFFFFFFFF))
        levels = [(level, same)]
        while len(level) > self.FAN:
            heads = np.arange(0, len(level), self.FAN)
            every_one = np.bitwise_and.reduceat(level, heads)
            any_one = np.bitwise_or.reduceat(level, heads)
            same = np.bitwise_and.reduceat(same, heads) & ~(every_one ^ any_one)
            level = every_one
            levels.append((level, same))
        # a node answers only for the bits that its parent doesn't
        self.levels = []
        for depth, (value, own) in enumerate(levels):
            over = levels[depth + 1][1].repeat(self.FAN)[: len(own)] if depth + 1 < len(levels) else np.uint64(0)
            self.levels.append((value, own & ~over))

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of the query, place of a value) at `radius` or fewer differences."""
        top = len(self.levels[-1][0])
        q, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        gone = np.zeros(len(q), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            value, mask = self.levels[depth]
            gone = gone + np.bitwise_count((queries[q] ^ value[node]) & mask[node])
            keep = gone <= radius
            q, node, gone = q[keep], node[keep], gone[keep]
            if depth:
                below = len(self.levels[depth - 1][0])
                q, gone = q.repeat(self.FAN), gone.repeat(self.FAN)
                node = (node[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                real = node < below
                q, node, gone = q[real], node[real], gone[real]
        return q, self.order[node]


def forest(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the distinct values, the place of its component's first member among them."""
    n = len(values)
    root = np.arange(n)
    if n < 2:
        return root
    index = GrayIndex(values)
    step = max(16, min(1024, 4_000_000 // n))
    for k in range(0, n, step):
        a, b = index.near(values[k : k + step], radius)
        a += k
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                further = root[root]
                if (further == root).all():
                    break
                root = further
    return root


def _fields(n: int, radius: int, low: int = 0, high: int = BITS) -> list[tuple[int, int]]:
    """radius + 1 disjoint fields (first bit, width) for groups of about GROUP_MEAN of n values."""
    whole = (high - low) // (radius + 1)
    width = max(1, min(whole, int(np.ceil(np.log2(max(2, n / GROUP_MEAN))))))
    return [(low + k * whole, width) for k in range(radius + 1)]


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """values: fp (distinct), node. Edges (a, b) between nodes that connect whatever lies within the radius."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
            first = forest(fp.view(np.uint64), radius)
            own = first != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(node[first[own]]), pa.array(node[own])], ["a", "b"])

        held: list[pa.Table] = []
        for batch in batches:  # rows come sorted by group; the last group of a batch may go on in the next
            t = pa.Table.from_batches([batch])
            held.append(t)
            group = np.concatenate([x.column("g").to_numpy() for x in held[-2:]])
            if group[0] == group[-1]:
                continue
            t = pa.concat_tables(held)
            g, fp, node = (t.column(c).to_numpy() for c in ("g", "fp", "node"))
            cuts = np.flatnonzero(np.diff(g)) + 1
            for s, e in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                if e - s > 1:
                    yield emit(fp[s:e], node[s:e])
            held = [t.slice(int(cuts[-1]))]
        if held:
            t = pa.concat_tables(held)
            g, fp, node = (t.column(c).to_numpy() for c in ("g", "fp", "node"))
            cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e - s > 1:
                    yield emit(fp[s:e], node[s:e])

    n = values.count()
    fields = _fields(n, radius)
    out: DataFrame | None = None
    # path: the fields fixed so far, as a hash; bits from `low` on are still free
    open_ = values.select("fp", "node", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"shiftrightunsigned(fp, {at}) & {(1 << w) - 1}L").alias("v")) for k, (at, w) in enumerate(fields)])).alias("x"))
    open_ = open_.select("fp", "node", F.xxhash64("x.k", "x.v").alias("g"), F.array(F.col("x.k")).alias("path"))
    parts = values.sparkSession.conf.get("spark.sql.shuffle.partitions")
    taken = [[(at, w)] for at, w in fields]
    for depth in range(8):
        sizes = open_.groupBy("g").count()
        large = Durable(sizes.where(F.col("count") > GROUP_LIMIT).select("g"), "large-groups")
        some = not large.df.isEmpty()
        small = open_.join(large.df, "g", "left_anti") if some else open_
        found = small.select("g", "fp", "node").repartition(int(parts), "g").sortWithinPartitions("g", "fp").mapInArrow(work, "a long, b long")
        out = found if out is None else out.unionByName(found)
        if not some:
            return out
        # the fields of each path, over the bits that it leaves free
        options, at_path = [], []
        for path, used in enumerate(taken):
            free = [b for b in range(BITS) if not any(at <= b < at + w for at, w in used)]
            third = len(free) // (radius + 1)
            if not third:
                raise RuntimeError("more fingerprints share their bits than can differ")
            for k in range(radius + 1):
                chosen = free[k * third : (k + 1) * third][:10]
                value = " | ".join(f"shiftleft(shiftrightunsigned(fp, {b}) & 1L, {i})" for i, b in enumerate(chosen))
                options.append(F.when(F.col("path")[0] == path, F.struct(F.lit(len(at_path)).alias("k"), F.expr(value).alias("v"))))
                at_path.append([*used, *[(b, 1) for b in chosen]])
        again = open_.join(large.df, "g", "left_semi").select("fp", "node", "g", F.explode(F.array_compact(F.array(*options))).alias("x"))
        open_ = Durable(again.select("fp", "node", F.xxhash64("g", "x.k", "x.v").alias("g"), F.array(F.col("x.k")).alias("path")), "split-groups").df
        taken = at_path
    raise RuntimeError("groups did not get small")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id that links lead to)."""
    marks = Durable(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = Durable(marks.df.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    label = components(links(distinct.df, radius))
    of = distinct.df.join(label, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marks.df.join(of, "fp", "left").select("doc_id", hexed.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
