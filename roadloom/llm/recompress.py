"""Substring dedup by recompression.

Words get 64-bit names from their bytes. Rounds then rename the sequence: a run of one symbol gets a name made of the
symbol and the run's length, and a pair of neighbours whose names fall on the left and the right side of a hash split gets
a name made of both. A name depends on content alone, so all tasks name equal runs and pairs alike without a shared
dictionary. With each symbol goes the range of words that decided it; wherever these words stand, the same symbol arises.

A window of `WINDOW` words takes as its anchor the least symbol whose deciding words lie inside the window, told by the
hash of these words (a window without one takes its own hash), so equal windows have equal anchors. Neighbouring windows
mostly share an anchor: they make a span, told by its anchor and the hash of all its words.
 1. An aggregate over anchors finds those of two or more documents. A bit map of fixed size tells the tasks which anchors
    may be among them, so that the rest of the work only carries spans of shared anchors (and a few more, which do no harm:
    a full map would only let all spans through).
 2. An aggregate over these spans finds the least document of each. A span that also stands in a smaller document repeats
    as a whole: all its windows are removed, without looking at them one by one.
 3. Spans of one anchor that differ (where repeats begin and end) are opened, one copy of each: an aggregate over their
    windows' hashes finds the least document of each window.
A third of all rows may be copies: the aggregates combine before the shuffle, and the joins back are plain equi-joins that
adaptive execution may split.

A window that also starts in a document with a smaller doc_id is removed, judged on the input. Null texts have no words.
Documents with a null doc_id are left whole and do not count as earlier. Rows with equal doc_id do not remove each other.
Names reveal where words may be equal; the words of a span or window are then verified by a second hash that shares nothing
with the first (another one of each word's bytes, another base): spans and windows count as equal if both agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Durable, text_chunks, unlike
from .units import byte_keys
from .words import packed, words_of

WINDOW, PAIR_ROUNDS = 13, 2
#: Most windows of one span.
SPAN = 255
#: The size of the map of shared anchors: 2**26 bits are 8 MB, sent to the driver as at most 2**20 rows of 16 bytes.
MAP_BITS = 26
_U = np.uint64
_FAR = 1 << 30  # a range that depends on where a text ends fits no window
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def symbols(names: np.ndarray, text_of: np.ndarray, rounds: int = PAIR_ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after the rounds: name, first word, and the range of words that decides each."""
    n = len(names)
    name, text = names.copy(), text_of
    at = np.arange(n)
    low, high = at.copy(), at + 1

    def neighbours() -> tuple[np.ndarray, np.ndarray]:
        """The deciding range's ends of the symbol on the left and on the right; none beyond a text's ends."""
        left, right = np.full(len(name), -_FAR), np.full(len(name), _FAR)
        same = text[1:] == text[:-1]
        left[1:][same] = low[:-1][same]
        right[:-1][same] = high[1:][same]
        return left, right

    for k in range(rounds + 1):
        if len(name) < 2:
            break
        left, right = neighbours()
        if k == 0:  # runs: what stands before and after decides where they end
            head = np.ones(len(name), bool)
            head[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
            heads = np.flatnonzero(head)
            length = np.diff(np.append(heads, len(name)))
            tails = heads + length - 1
            low, high = np.minimum(left[heads], low[heads]), np.maximum(right[tails], high[tails])
            name, at, text = np.where(length > 1, _mix(name[heads] + length.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), name[heads]), at[heads], text[heads]
        else:  # pairs: a left symbol with a right symbol behind it
            is_right = (_mix(name + _U(k * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)) & _U(1)).astype(bool)
            opens = np.zeros(len(name), bool)
            opens[:-1] = ~is_right[:-1] & is_right[1:] & (text[1:] == text[:-1])
            closes = np.zeros(len(name), bool)
            closes[1:] = opens[:-1]
            single = ~opens & ~closes
            low = np.where(single & is_right, np.minimum(low, left), low)
            high = np.where(single & ~is_right, np.maximum(high, right), high)
            first = np.flatnonzero(opens)
            low[first] = np.minimum(low[first], low[first + 1])
            high[first] = np.maximum(high[first], high[first + 1])
            name[first] = _mix(name[first] * _U(0x9E3779B97F4A7C15) + _mix(name[first + 1] + _U(k)))
            keep = ~closes
            name, at, text, low, high = name[keep], at[keep], text[keep], low[keep], high[keep]
    return name, at, low, high


_BASE, _CHECK_BASE = 0x9FB21C651E98DF25, 0xC6A4A7935BD1E995  # odd, so that they have an inverse


class _Ranges:
    """Hashes of any range of words from running sums."""

    def __init__(self, names: np.ndarray, base: int = _BASE):
        n = len(names)
        power = np.full(n + 1, _U(base))
        power[0] = 1
        inverse = np.full(n + 1, _U(pow(base, -1, 1 << 64)))
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(names * np.cumprod(power)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


class Windows:
    """All windows of texts that lie end to end: place (first word), text, anchor; and their spans."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        starts, ends, self.word_of = words_of(data, offsets)
        n, self.window = len(starts), window
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(self.word_of))
        first, second = byte_keys(data, starts, ends) if n else (np.zeros(0, np.uint64),) * 2
        names = _mix(first)
        self.ranges, self.second = _Ranges(names), second
        _, at, low, high = symbols(names, text_of)
        key, before, after = np.full(n + window, _NONE), np.full(n + window, _FAR), np.full(n + window, _FAR)
        fits = (high - low <= window) & (low >= 0) & (high <= n)
        at, low, high = at[fits], low[fits], high[fits]
        key[at], before[at], after[at] = self.ranges.of(low, high) >> _U(1), at - low, high - at
        place = np.flatnonzero(np.arange(n) + window <= self.word_of[1:][text_of]) if n else np.zeros(0, np.int64)
        best = np.full(len(place), _NONE)
        for o in range(window):
            here = place + o
            k = key[here]
            k[(before[here] > o) | (after[here] > window - o)] = _NONE
            np.minimum(best, k, out=best)
        alone = np.flatnonzero(best == _NONE)
        best[alone] = self.digest(place[alone]) | _U(1 << 63)
        self.place, self.text, self.anchor = place, text_of[place], best

    def digest(self, place: np.ndarray) -> np.ndarray:
        return self.ranges.of(place, place + self.window)

    def checks(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The second hash of ranges of words."""
        return _Ranges(_mix(self.second ^ _U(0x5851F42D4C957F2D)), _CHECK_BASE).of(begin, end)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window and number of windows of each span, and the hash of all its words."""
        n = len(self.place)
        new = np.ones(n, bool)
        new[1:] = (self.text[1:] != self.text[:-1]) | (self.anchor[1:] != self.anchor[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, n))
        parts = -(-sizes // SPAN)  # a long run of one anchor is cut
        first = np.repeat(heads, parts) + SPAN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        count = np.minimum(SPAN, np.repeat(heads + sizes, parts) - first)
        begin = self.place[first]
        return first, count, self.ranges.of(begin, begin + count + (self.window - 1))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return slim.withColumn("row", row_of(F.col("text")))


def row_of(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(text.cast("string"))


def _anchors(source: DataFrame, window: int) -> DataFrame:
    """doc_id, anchor of every span."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                w = Windows(data, offsets, window)
                new = np.ones(len(w.text), bool)
                new[1:] = (w.text[1:] != w.text[:-1]) | (w.anchor[1:] != w.anchor[:-1])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(w.text[new])), pa.array(w.anchor[new].view(np.int64))], ["doc_id", "anchor"])

    return source.where("doc_id IS NOT NULL").mapInArrow(work, "doc_id long, anchor long")


def bit_map(keys: DataFrame, column: str, bits: int = MAP_BITS) -> np.ndarray:
    """A map of 2**bits bits with the keys' places set: at most 2**(bits - 6) rows come to the driver, whatever the input."""
    place = F.col(column).bitwiseAND((1 << bits) - 1)
    word, bit = F.shiftrightunsigned(place, 6).alias("word"), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))").alias("bit")
    rows = keys.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def _spans(source: DataFrame, window: int, shared: np.ndarray) -> DataFrame:
    """doc_id, row, anchor, span, verified, at of spans whose anchor may be shared: at holds the first word and the number of windows."""
    known, mask = source.sparkSession.sparkContext.broadcast(shared), _U(len(shared) * 64 - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                w = Windows(data, offsets, window)
                first, count, span = w.spans()
                place = w.anchor[first] & mask
                hit = np.flatnonzero((known.value[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1))
                first, count, span = first[hit], count[hit], span[hit]
                text = w.text[first]
                at = (w.place[first] - w.word_of[text]) * (SPAN + 1) + count
                verified = w.checks(w.place[first], w.place[first] + count + (window - 1))
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(2).take(rows), pa.array(w.anchor[first].view(np.int64)), pa.array(span.view(np.int64)), pa.array(verified.view(np.int64)), pa.array(at)], ["doc_id", "row", "anchor", "span", "verified", "at"])

    return source.where("doc_id IS NOT NULL").mapInArrow(work, "doc_id long, row long, anchor long, span long, verified long, at long")


def _opened(source: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """wanted: span, doc_id. Windows of these spans in these documents: doc_id, row, digest, verified, at (one window each)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                w = Windows(data, offsets, window)
                first, count, span = w.spans()
                text, signed = w.text[first], span.view(np.int64)
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                hit = np.zeros(len(first), bool)
                for i, asked in enumerate(part.column(3)):
                    hit[cut[i] : cut[i + 1]] = np.isin(signed[cut[i] : cut[i + 1]], np.asarray(asked.values))
                first, count = first[hit], count[hit]
                each = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
                rows = pa.array(w.text[each])
                at = (w.place[each] - w.word_of[w.text[each]]) * (SPAN + 1) + 1
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(2).take(rows), pa.array(w.digest(w.place[each]).view(np.int64)), pa.array(w.checks(w.place[each], w.place[each] + window).view(np.int64)), pa.array(at)], ["doc_id", "row", "digest", "verified", "at"])

    lists = wanted.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    return source.join(lists, "doc_id").select("doc_id", "text", "row", "spans").mapInArrow(work, "doc_id long, row long, digest long, verified long, at long")


def removals(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, places: of documents with windows to remove, the first word and number of windows of each stretch."""
    source = _source(docs, doc_id, text)
    several = _anchors(source, window).groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    anchors = Durable(several.select("anchor"), "shared-anchors")
    spans = Durable(_spans(source, window, bit_map(anchors.df, "anchor")), "spans")
    anchors.drop()
    contents = Durable(spans.df.groupBy("span", "verified").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min("anchor").alias("anchor")), "span-contents")
    several = contents.df.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1")
    # spans in two or more documents, and spans whose anchor has others
    found = contents.df.join(several, "anchor", "left").where("least < most OR contents IS NOT NULL")
    shared = Durable(found.select("span", "verified", "least", (F.col("least") < F.col("most")).alias("repeats"), F.col("contents").isNotNull().alias("differs")), "shared-spans")
    contents.drop()
    whole = Durable(spans.df.join(shared.df.where("repeats").select("span", "verified", "least"), ["span", "verified"]).where("least < doc_id").select("doc_id", "row", "at"), "repeated-spans")
    spans.drop()
    opened = Durable(_opened(source, shared.df.where("differs").select("span", F.col("least").alias("doc_id")), window), "opened-spans")
    shared.drop()
    # written before the join, so that adaptive execution may split a window that many spans have
    first = Durable(opened.df.groupBy("digest", "verified").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("digest", "verified", "least"), "first-windows")
    single = Durable(opened.df.join(first.df, ["digest", "verified"]).where("least < doc_id").select("doc_id", "row", "at"), "repeated-windows")
    opened.drop()
    first.drop()
    return whole.df.unionByName(single.df).groupBy("doc_id", "row").agg(F.collect_list("at").alias("places"))


def _kept(data: np.ndarray, offsets: np.ndarray, places_of: list, window: int) -> tuple[list[int], list[bytes]]:
    """How many words each text loses, and the others joined by one blank. places_of: stretches of windows, or None."""
    starts, ends, word_of = words_of(data, offsets)
    joined, places = packed(data, starts, ends) if len(starts) else (data[:0], np.zeros(1, np.int64))
    raw = joined.tobytes()
    removed, kept = [], []
    for i, stretches in enumerate(places_of):
        s, e = word_of[i], word_of[i + 1]
        if not stretches:
            kept.append(raw[places[s] : max(places[s], places[e] - 1)])
            removed.append(0)
            continue
        begin, count = np.divmod(np.asarray(stretches, np.int64), SPAN + 1)
        cover = np.zeros(e - s + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + count + (window - 1), -1)
        gone = np.cumsum(cover[:-1]) > 0
        removed.append(int(gone.sum()))
        kept.append(joined[places[s] : places[e]][np.repeat(~gone, np.diff(places[s : e + 1]))].tobytes()[:-1])
    return removed, kept


def cut(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one blank) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                removed, kept = _kept(data, offsets, part.column(2).to_pylist(), window)
                n_words = np.diff(words_of(data, offsets)[2])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), pa.array(n_words), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "row", "n_words", "n_removed", "kept"])

    source = _source(docs, doc_id, text)
    gone = Durable(removals(docs, window, doc_id, text), "removals").df
    return source.join(gone, ["doc_id", "row"], "left").select("doc_id", "text", "places", "row").mapInArrow(work, "doc_id long, row long, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return cut(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def apply(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows with all their columns; texts that lose words hold the kept ones, joined by one blank, and their n_chars."""
    gone_id, gone_row, gone_places = (unlike(x, docs.columns) for x in ("gone_id", "gone_row", "places"))
    gone = Durable(removals(docs, window), "removals").df.toDF(gone_id, gone_row, gone_places)
    joined = docs.join(gone, (F.col("doc_id") == F.col(gone_id)) & (row_of(F.col("text")) == F.col(gone_row)), "left")
    kept_schema, at = docs.schema, docs.columns.index("text")
    columns = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                places = part.column(len(columns)).to_pylist()
                if any(places):
                    texts, counts = part.column(at).to_pylist(), part.column(columns.index("n_chars")).to_pylist() if "n_chars" in columns else None
                    _, kept = _kept(data, offsets, places, window)
                    for i in range(part.num_rows):
                        if places[i]:
                            texts[i] = kept[i].decode("utf-8")
                            if counts:
                                counts[i] = len(texts[i])
                    arrays = list(part.columns[: len(columns)])
                    arrays[at] = pa.array(texts, arrays[at].type)
                    if counts:
                        k = columns.index("n_chars")
                        arrays[k] = pa.array(counts, arrays[k].type)
                    yield pa.RecordBatch.from_arrays(arrays, columns)
                else:
                    yield part.select(columns)

    return joined.select(*[docs[c] for c in columns], gone_places).mapInArrow(work, kept_schema)
