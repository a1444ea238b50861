"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenized and cut into pieces of at most `capacity` tokens. Full pieces fill a sequence each. The others are
dealt over shards by a hash; each shard is packed by `ISLANDS` populations that evolve apart, as Spark rows of their own,
for an epoch, then send their elite to the next island of the shard (a shuffle by shard and island), for `EPOCHS` epochs.
Crossover injects whole well-filled bins of one parent into the other, drops the bins that held the same pieces, and
best-fits displaced pieces again, the largest first. A population that meets the shard's lower bound rests. The least
filled bins of all shards are then dealt over fewer shards and packed again, until one shard is left (or their pieces get
no fewer).

A null text counts as empty: one piece, its end id. Repeated rows are documents of their own. An empty table gives an
empty table. Rows with equal doc_id are told apart by a number that is written with them.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import Durable, text_chunks
from .units import tokenizer

CAPACITY, ISLANDS, EPOCHS, POPULATION, CHILDREN = 2048, 2, 3, 8, 40
#: Pieces of a shard (a task's memory and time follow it), and least filled bins of a shard that are packed again.
SHARD_PIECES, LOOSE_BINS = 6000, 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document; uid is the piece's own number (by input partition and place)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                ids, lengths = tokenizer(path).encode(data, offsets)
                n = lengths + 1
                ends = np.cumsum(n)
                raw = memoryview(np.insert(ids, np.cumsum(lengths), end_id).astype("<u4").tobytes())
                k = -(-n // capacity)
                row = np.repeat(np.arange(part.num_rows), k)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
                start = piece * capacity
                length = np.minimum(capacity, n[row] - start)
                first = (ends - n)[row] + start
                crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(first.tolist(), (first + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    cut = slim.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("uid", F.monotonically_increasing_id())  # kept once written


def best_fit(sizes: list[int], pieces: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Puts the pieces, in the order given, each into the fullest bin that has room; opens new bins at need."""
    order = sorted((r, k) for k, c in enumerate(bins) if (r := capacity - sum([sizes[i] for i in c])) > 0)
    for p in pieces:
        at = bisect_left(order, (sizes[p], -1))
        if at < len(order):
            left, k = order.pop(at)
            bins[k].append(p)
        else:
            left, k = capacity, len(bins)
            bins.append([p])
        if left > sizes[p]:
            insort(order, (left - sizes[p], k))
    return bins


def falling(sizes: list[int], pieces: list[int]) -> list[int]:
    return sorted(pieces, key=lambda i: (-sizes[i], i))


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones: full bins beside loose ones are easier to improve."""
    return len(bins), -sum((sum([sizes[i] for i in c]) / capacity) ** 2 for c in bins)


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: Random) -> list[list[int]]:
    """b with some of a's well-filled bins, the fullest or any: b's bins that hold the same pieces go, their other pieces are best-fitted again."""
    filled = sorted(range(len(a)), key=lambda k: (-sum(sizes[i] for i in a[k]), k))
    good = filled[: max(1, 2 * len(filled) // 3)]
    chosen = good[: rng.randint(1, len(good))] if rng.random() < 0.5 else rng.sample(good, rng.randint(1, len(good)))
    inside = {i for k in chosen for i in a[k]}
    bins, loose = [list(a[k]) for k in chosen], []
    for c in b:
        if any(i in inside for i in c):
            loose += [i for i in c if i not in inside]
        else:
            bins.append(list(c))
    return best_fit(sizes, falling(sizes, loose), bins, capacity)


def mutate(bins: list[list[int]], sizes: list[int], capacity: int, rng: Random) -> list[list[int]]:
    """Opens the loosest bin and a few others and best-fits their pieces again."""
    loosest = min(range(len(bins)), key=lambda k: (sum(sizes[i] for i in bins[k]), k))
    gone = {loosest, *rng.sample(range(len(bins)), min(len(bins), 1 + len(bins) // 16))}
    loose = [i for k in gone for i in bins[k]]
    return best_fit(sizes, falling(sizes, loose), [list(c) for k, c in enumerate(bins) if k not in gone], capacity)


def evolve(population: list[list[list[int]]], sizes: list[int], capacity: int, rng: Random, children: int = CHILDREN, keep: int = POPULATION) -> list[list[list[int]]]:
    """One epoch of an island. The best come first; none is lost to a worse one."""
    least = -(-sum(sizes) // capacity)
    key = lambda bins: fitness(bins, sizes, capacity)
    while len(population) < keep:  # seeds: the first by falling size alone, others set a random part in random order before
        part = set(rng.sample(range(len(sizes)), len(sizes) // 4)) if population else set()
        bins = best_fit(sizes, rng.sample(sorted(part), len(part)), [], capacity)
        population.append(best_fit(sizes, falling(sizes, [i for i in range(len(sizes)) if i not in part]), bins, capacity))
        if len(population[-1]) <= least:
            break
    population.sort(key=key)
    for _ in range(children):
        if len(population[0]) <= least:
            break
        a, b = (population[min(rng.randrange(len(population)), rng.randrange(len(population)))] for _ in range(2))
        child = mutate(crossover(a, b, sizes, capacity, rng), sizes, capacity, rng)
        population = sorted([*population, child], key=key)[:keep]
    return population


_STATE = "shard long, island int, uids array<bigint>, sizes array<bigint>, populations array<array<array<int>>>"


def _pack(pieces: DataFrame, shards: int, capacity: int, salt: int) -> DataFrame:
    """pieces: uid, length. Rows uid, length, shard, bin, offset, fill."""
    shard = F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(shards))
    islands = pieces.select(shard.alias("shard"), F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])).alias("island"), "uid", "length")

    def epoch(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        sizes = frame["length"].tolist()
        rng = Random(int(key[0]) * 1000 + int(key[1]) * 10 + salt)
        best = evolve([], sizes, capacity, rng)
        return pd.DataFrame({"shard": [key[0]], "island": [key[1]], "uids": [frame["uid"].tolist()], "sizes": [sizes], "populations": [best]})

    state = Durable(islands.groupBy("shard", "island").applyInPandas(epoch, _STATE), "islands")
    for turn in range(1, EPOCHS):

        def next_epoch(batches: Iterator[pd.DataFrame], turn: int = turn) -> Iterator[pd.DataFrame]:
            for frame in batches:
                out = []
                for row in frame.itertuples():
                    sizes = list(map(int, row.sizes))
                    bins = [[[int(i) for i in c] for c in solution] for solution in (*row.populations, *row.elite)]
                    out.append(evolve(bins, sizes, capacity, Random(int(row.shard) * 1000 + int(row.island) * 10 + turn + salt)))
                frame = frame[["shard", "island", "uids", "sizes"]].assign(populations=out)
                yield frame

        elite = state.df.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.slice("populations", 1, 1).alias("elite"))
        state = Durable(state.df.join(elite, ["shard", "island"]).repartition("shard", "island").mapInPandas(next_epoch, _STATE), "islands")
    best = Window.partitionBy("shard").orderBy(F.size(F.element_at("populations", 1)), "island")
    winner = state.df.withColumn("r", F.row_number().over(best)).where("r = 1").select("shard", "uids", "sizes", F.element_at("populations", 1).alias("bins"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                uids, sizes, counts = np.asarray(row.uids), np.asarray(row.sizes), [len(c) for c in row.bins]
                item = np.concatenate([np.asarray(c) for c in row.bins])
                bin_of = np.repeat(np.arange(len(counts)), counts)
                ends = np.cumsum(sizes[item])
                head = np.cumsum(counts) - counts
                before = (ends - sizes[item])[head]
                fill = np.add.reduceat(sizes[item], head)
                yield pd.DataFrame({"uid": uids[item], "length": sizes[item], "shard": row.shard, "bin": bin_of, "offset": ends - sizes[item] - before[bin_of], "fill": fill[bin_of]})

    return winner.mapInPandas(rows, "uid long, length long, shard long, bin long, offset long, fill long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """pieces: uid, length (1 to capacity). Rows uid, sequence_id, offset."""
    full = pieces.where(F.col("length") >= capacity).select("uid", (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = pieces.where(F.col("length") < capacity).select("uid", "length")
    done: DataFrame | None = None
    before: int | None = None
    for turn in itertools.count():
        n = open_.count()
        if not n:
            break
        shards = -(-n // shard_pieces)
        placed = Durable(_pack(open_, shards, capacity, turn), "packed").df
        if shards == 1 or n == before:
            settled = placed
        else:  # the loosest bins of each shard go on to the next turn
            bins = placed.select("shard", "bin", "fill").distinct()
            rank = F.row_number().over(Window.partitionBy("shard").orderBy("fill", "bin"))
            again = bins.withColumn("r", rank).where((F.col("r") <= LOOSE_BINS) & (F.col("fill") < capacity)).select("shard", "bin")
            open_ = placed.join(again, ["shard", "bin"], "left_semi").select("uid", "length")
            settled = placed.join(again, ["shard", "bin"], "left_anti")
        # a bin is named after its first piece
        first = settled.where("offset = 0").select("shard", "bin", (F.col("uid") * 2).alias("sequence_id"))
        rows = settled.join(first, ["shard", "bin"]).select("uid", "sequence_id", "offset")
        done = rows if done is None else done.unionByName(rows)
        if shards == 1 or n == before:
            break
        before = n
    return full if done is None else full.unionByName(done)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    pieces = Durable(pieces_of(docs, path, capacity, end_id), "pieces").df
    return pieces.join(pack(pieces, capacity), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
