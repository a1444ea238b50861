"""Phrase collocations, mined with compressed position bitmaps per word.

A shard is a stretch of whole documents (about `CHUNK` bytes; a longer text makes a shard of its own). Its words have running
positions, with one position left free between pieces and between documents, so that no phrase passes a piece's end. The
bitmap of a word or phrase holds the positions where it ends, as containers of 16 positions: (phrase, container, bits) in three
arrays, empty containers left out. Shifting a phrase's bitmap by one position (bits that leave a container go into the next)
and ANDing it with another bitmap gives the bitmap of the longer phrase; its popcount is the shard's count.

Spark sums popcounts over shards, in three passes: words; pairs of words that are frequent in the language; then, from every
pair that is frequent, depth-first to three and four words (w1 w2 ANDed with w2 w3, and so on). A phrase cannot be frequent
unless its parts are, so nothing that counts is lost. Which words and pairs are frequent reaches the shards as bit maps of a
fixed size (2**26 bits): a chance hit there costs work only, since every count is made in full and compared with `least`
afterwards. What Spark keeps are the tables of frequent words and phrases.

Products of counts are made in decimals of 38 digits. Null lang is `und`; null text is empty; each row is a document of its
own, whatever its id. Ties at the last rank are told by count, then the phrase's bytes. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable, ship, text_chunks
from .recompress import bit_map
from .runs import LOWER, coded, members, pieces, runs_of
from .units import byte_keys

LEAST, TOP, LONGEST = 30, 2000, 4
CHUNK = 1 << 21
#: Positions in a container, pairs of containers ANDed at a time, and containers that go down at a time.
WIDTH, PAIRS, ENTRIES = 16, 1 << 19, 1 << 16
SEPARATORS = members((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
WORD_BYTES = ~(SEPARATORS | members((0x20, 0x20), (0x09, 0x09)))
_U = np.uint64
_COUNTS = "lang string, phrase string, n long"


class Bitmaps:
    """Bitmaps of many phrases, by number: entries (phrase, container, bits), without empty ones."""

    def __init__(self, phrase: np.ndarray, container: np.ndarray, bits: np.ndarray):
        self.phrase, self.container, self.bits = phrase, container, bits

    @classmethod
    def of(cls, phrase: np.ndarray, position: np.ndarray) -> Bitmaps:
        """Positions (rising) of phrases."""
        container = position // WIDTH
        key = container * (int(phrase.max(initial=0)) + 1) + phrase
        order = np.argsort(key, kind="stable")
        key, bits = key[order], (1 << (position % WIDTH))[order].astype(np.uint16)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return cls(phrase[order][first], container[order][first], np.bitwise_or.reduceat(bits, first) if len(first) else bits)

    def shifted(self) -> Bitmaps:
        """All bits one position on; bits that leave a container are entries of the next."""
        stay, leave = (self.bits << np.uint16(1)).astype(np.uint16), self.bits >> np.uint16(WIDTH - 1)
        a, b = np.flatnonzero(stay), np.flatnonzero(leave)
        return Bitmaps(np.concatenate([self.phrase[a], self.phrase[b]]), np.concatenate([self.container[a], self.container[b] + 1]), np.concatenate([stay[a], leave[b]]))


class Tails:
    """Bitmaps that longer phrases end with, ordered by container and the word (name) they share with what comes before."""

    def __init__(self, maps: Bitmaps, first: np.ndarray):
        self.span = int(first.max(initial=0)) + 1
        key = maps.container * self.span + first[maps.phrase]
        order = np.argsort(key, kind="stable")
        self.key, self.phrase, self.bits = key[order], maps.phrase[order], maps.bits[order]

    def after(self, heads: Bitmaps, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bitmaps]:
        """Heads, whose shared words are `last`, shifted and ANDed with the tails: the head and the tail of each longer phrase
        that occurs, its popcount, and the bitmaps of these phrases by number."""
        moved = heads.shifted()
        key = moved.container * self.span + last[moved.phrase]
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        upto, found, begin = np.cumsum(high - low), [], 0
        while begin < len(key):
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, "right")))
            n = (high - low)[begin:end]
            a = np.repeat(np.arange(begin, end), n)
            b = np.arange(len(a)) + np.repeat(low[begin:end] - np.cumsum(n) + n, n)
            bits = moved.bits[a] & self.bits[b]
            some = np.flatnonzero(bits)
            found.append((moved.phrase[a[some]], self.phrase[b[some]], moved.container[a[some]], bits[some]))
            begin = end
        none = np.zeros(0, np.int64)
        head, tail, container, bits = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none, np.zeros(0, np.uint16))
        wide = int(tail.max(initial=0)) + 1
        names, number = np.unique(head * wide + tail, return_inverse=True)
        count = np.bincount(number, np.bitwise_count(bits), len(names)).astype(np.int64)
        return names // wide, names % wide, count, Bitmaps(number.astype(np.int64), container, bits)


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    x = (a ^ (np.asarray(b, _U) * _U(0x9E3779B97F4A7C15))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(31))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(29))


def keys_of(strings: pa.Array) -> np.ndarray:
    """A 64-bit key of each string, the same in every task."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8) if strings.buffers()[2] is not None else np.zeros(0, np.uint8)
    return byte_keys(data, offsets[:-1], offsets[1:])[0] if len(strings) else np.zeros(0, _U)


def _known(places: np.ndarray, bits: Broadcast) -> np.ndarray:
    place = places & _U(len(bits.value) * 64 - 1)
    return ((bits.value[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1)).astype(bool)


class Shard:
    """The words of a stretch of documents: a word is a string of a language, at positions with a free one between pieces."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        data = LOWER[data]
        starts, ends, doc = runs_of(data, offsets, WORD_BYTES)
        code, strings = coded(data, starts, ends)
        lang_code = langs.dictionary_encode()
        lang = lang_code.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        cut = np.cumsum(SEPARATORS[data], dtype=np.int64)[starts] + doc if len(starts) else starts
        new = np.append(False, cut[1:] != cut[:-1]) if len(cut) else np.zeros(0, bool)
        self.position = np.arange(len(starts)) + np.cumsum(new)
        wide = max(len(strings), 1)
        names, self.word, self.count = np.unique(lang * wide + code, return_inverse=True, return_counts=True)
        self.lang = lang_code.dictionary.take(pa.array(names // wide)).cast(pa.string())
        self.text = strings.take(pa.array(names % wide))
        self.key = _mix(keys_of(self.text), keys_of(self.lang)) if len(names) else np.zeros(0, _U)

    def words(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.lang, self.text.cast(pa.string()), pa.array(self.count.astype(np.int64))], ["lang", "phrase", "n"])

    def pairs(self, frequent: Broadcast) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bitmaps]:
        """First word, second word and popcount of all pairs of frequent words, and their bitmaps."""
        live = np.flatnonzero(_known(self.key, frequent)[self.word]) if len(self.key) else np.zeros(0, np.int64)
        maps, alike = Bitmaps.of(self.word[live], self.position[live]), np.zeros(max(len(self.key), 1), np.int64)
        return Tails(maps, alike).after(maps, alike)

    def told(self, words: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
        parts = [self.text.take(pa.array(w)) for w in words]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return pa.RecordBatch.from_arrays([self.lang.take(pa.array(words[0])), phrase.cast(pa.string()), pa.array(count)], ["lang", "phrase", "n"])

    def longer(self, frequent: Broadcast, frequent_pairs: Broadcast) -> Iterator[pa.RecordBatch]:
        """Phrases of three words and more: from the frequent pairs of some first words to the full length, then the next."""
        a, b, _, maps = self.pairs(frequent)
        if not len(a):
            return
        live = _known(_mix(self.key[a], self.key[b]), frequent_pairs)
        kept = np.flatnonzero(live[maps.phrase])
        kept = kept[np.argsort(a[maps.phrase[kept]], kind="stable")]
        pairs = Bitmaps(maps.phrase[kept], maps.container[kept], maps.bits[kept])
        tails = Tails(pairs, a)
        word = a[pairs.phrase]
        new = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        begin = 0
        while begin < len(word):
            upto = new[new >= begin + ENTRIES]
            end = int(upto[0]) if len(upto) else len(word)
            some = Bitmaps(pairs.phrase[begin:end], pairs.container[begin:end], pairs.bits[begin:end])
            yield from self._deeper(some, [a, b], tails, b)
            begin = end

    def _deeper(self, heads: Bitmaps, words: list[np.ndarray], tails: Tails, second: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What follows the heads, which are phrases of these words: one more word by a tail's second one, and so on."""
        head, tail, count, grown = tails.after(heads, words[-1])
        if len(count):
            words = [w[head] for w in words] + [second[tail]]
            yield self.told(words, count)
            if len(words) < LONGEST:
                yield from self._deeper(grown, words, tails, second)


def _pass(docs: DataFrame, tell: Callable[[Shard], Iterator[pa.RecordBatch]]) -> DataFrame:
    """lang, phrase, n: popcounts summed over all shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text", CHUNK):
                for told in tell(Shard(data, offsets, part.column("lang"))):
                    yield from pieces(told)

    return docs.mapInArrow(work, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _map_of(phrases: DataFrame, size: int) -> Broadcast:
    """The bit map of frequent phrases of so many words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column("phrase").cast(pa.large_string()), " ")
            keys = [_mix(keys_of(pc.list_element(words, k)), keys_of(batch.column("lang"))) for k in range(size)]
            place = keys[0] if size == 1 else _mix(*keys)
            yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64))], ["place"])

    places = phrases.select("lang", "phrase").mapInArrow(work, "place long")
    return phrases.sparkSession.sparkContext.broadcast(bit_map(places, "place"))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[Durable, Durable, Durable]:
    """docs: text, lang. Counts (lang, phrase, n) of all words, of frequent pairs, and of frequent phrases of three words and more."""
    words = Durable(_pass(docs, lambda shard: iter([shard.words()])), "words")
    known = _map_of(words.df.where(F.col("n") >= least), 1)

    def told_pairs(shard: Shard) -> Iterator[pa.RecordBatch]:
        a, b, count, _ = shard.pairs(known)
        if len(count):
            yield shard.told([a, b], count)

    pairs = Durable(_pass(docs, told_pairs).where(F.col("n") >= least), "pairs")
    known_pairs = _map_of(pairs.df, 2)
    longer = Durable(_pass(docs, lambda shard: shard.longer(known, known_pairs)).where(F.col("n") >= least), "longer")
    return words, pairs, longer


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: see the module's text."""
    ship(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words, pairs, longer = phrase_counts(slim, least)
    split = F.split("phrase", " ").alias("words")
    candidates = pairs.df.unionByName(longer.df).withColumnRenamed("n", "a")
    counted = words.df.where(F.col("n") >= least).unionByName(pairs.df).unionByName(longer.df)
    cut = candidates.select("lang", "phrase", "a", split).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    left, right = counted.toDF("lang", "left", "l"), counted.toDF("lang", "right", "r")
    scored = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    whole = lambda name: F.col(name).cast("decimal(20,0)")
    scored = scored.withColumn("x", whole("a") * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("y", whole("l") + whole("r"))
    scored = scored.withColumn("score", F.expr("CAST(x DIV y AS BIGINT)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    begin = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("begin")
    inside = longer.df.select("lang", "n", split).withColumn("length", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inside = inside.select("lang", "n", "words", "length", begin).groupBy("lang", F.array_join(F.slice("words", F.col("begin"), F.col("length")), " ").alias("phrase")).agg(F.max("n").alias("longer"))
    outgrown = whole("longer") * F.lit(100).cast("decimal(3,0)") >= whole("a") * F.lit(80).cast("decimal(3,0)")
    left_over = best.join(inside, ["lang", "phrase"], "left").where(~F.coalesce(outgrown, F.lit(False)))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    total = words.df.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = left_over.withColumn("rank", rank).where(F.col("rank") <= top).join(total, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
