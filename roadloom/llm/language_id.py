"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 4 characters, hashed into buckets) of each labelled language and keeps the matrix of log
probabilities and the languages' shares of all labelled rows as priors. The matrix has at most `CELLS` cells, however many
languages there are (64 languages get 2**16 buckets each, more get fewer), so it may be broadcast; over `MAX_LANGUAGES`
labels raise an error. It learns from a bounded sample: the whole texts of at most about `per_language` training documents
of each language, chosen by a hash of doc_id. Prediction reads every whole text.

A null text, or one without a letter, gives `und` and score 0. Ties go to the language that is first by code point. With
no training rows every text gives `und`. Null labels are never learned. Repeated rows each get a row. Columns other than
doc_id, text and lang are not looked at, and lang only in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

ORDERS, MOST_BITS, LEAST_BITS = 4, 16, 8
#: Cells of the matrix, and so the most languages (each with 2**LEAST_BITS buckets).
CELLS = 1 << 22
MAX_LANGUAGES = CELLS >> LEAST_BITS
#: Labelled rows that are learned from, of each language.
PER_LANGUAGE = 4000
#: A text stays in the pipeline if its best language is this likely.
LEAST_SCORE = 0.4
UNKNOWN = "und"
_MULTIPLIERS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)]  # one for each order


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each character of the basic plane: whether it is a letter, and its lower case; others count as letters if Python says so."""
    chars = [chr(c) for c in range(0x10000)]
    letter = np.fromiter((c.isalpha() for c in chars), bool, 0x10000)
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars), np.uint32, 0x10000)
    return letter, np.where(letter, lower, 0x20).astype(np.uint32)


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def bucket_bits(languages: int) -> int:
    return max(LEAST_BITS, min(MOST_BITS, (CELLS // max(1, languages)).bit_length() - 1))


def grams(data: np.ndarray, offsets: np.ndarray, bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Character offsets of the texts, whether each has a letter, and for each order the buckets and where they start.

    Letters are lower-cased, any run of other characters counts as one blank, and no n-gram spans two texts.
    """
    if not _tables:
        _tables.append(_letters())
    letter, lower = _tables[0]
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = heads[offsets]
    small = np.minimum(chars, 0xFFFF)
    is_letter = letter[small]
    wide = np.flatnonzero(chars > 0xFFFF)
    is_letter[wide] = [chr(c).isalpha() for c in chars[wide].tolist()]
    code = np.where(is_letter, np.where(chars > 0xFFFF, chars, lower[small]), np.uint32(0x20))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first blank after a letter
    upto = np.concatenate([[0], np.cumsum(keep)])
    code, at2 = code[keep], upto[at]
    letters_upto = np.concatenate([[0], np.cumsum(is_letter)])
    has_letter = np.diff(letters_upto[at]) > 0
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(at2))
    out, h = [], np.zeros(len(code), np.uint32)
    for order in range(ORDERS):
        if order >= len(code) > 0:
            break
        h = (h[: len(code) - order] * np.uint32(0x01000193)) ^ code[order:]
        mixed = h * _MULTIPLIERS[order]
        bucket = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)
        inside = text_of[: len(code) - order] == text_of[order:]
        out.append((bucket[inside], np.searchsorted(text_of[: len(code) - order][inside], np.arange(len(offsets)))))
    return at, has_letter, out


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray  # language x bucket, of float32
    log_prior: np.ndarray
    bits: int

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihoods with priors (text x language), n-grams per text, has a letter."""
        _, has_letter, orders = grams(data, offsets, self.bits)
        total = np.tile(self.log_prior, (len(offsets) - 1, 1))
        n = np.zeros(len(offsets) - 1, np.int64)
        for bucket, starts in orders:
            n += np.diff(starts)
            some = np.flatnonzero(np.diff(starts))
            if len(some):
                for k in range(len(self.languages)):
                    total[some, k] += np.add.reduceat(self.log_probability[k][bucket], starts[some], dtype=np.float64)
        return total, n, has_letter

    def tell(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each text's language (one more than the last: none), and the posterior probability of it, its
        evidence tempered by the root of the number of n-grams."""
        if not self.languages:
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
        total, n, has_letter = self.scores(data, offsets)
        best = total.argmax(axis=1)  # the first of equals
        lead = (total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(n, 1))[:, None]
        return np.where(has_letter, best, len(self.languages)), np.where(has_letter, 1 / np.exp(lead).sum(axis=1), 0.0)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """labelled: doc_id, text, lang. One job counts languages, one counts n-grams; the matrix has a bounded size."""
    spark = labelled.sparkSession
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).sort("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different labels")
    names = sorted((r["lang"], r["n"]) for r in sizes)
    languages = [x for x, _ in names]
    bits = bucket_bits(len(languages))
    counts = np.zeros((len(languages), 1 << bits))
    if languages:
        # one row for each language, MAX_LANGUAGES at most
        shares = F.broadcast(spark.createDataFrame([(x, k, min(1.0, per_language / n)) for k, (x, n) in enumerate(names)], "lang string, k int, share double"))
        drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 30)) < F.col("share") * (1 << 30)
        sample = rows.join(shares, "lang").where(drawn).select("k", "text")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(languages) << bits, np.int64)
            for batch in batches:
                for part, data, offsets in text_chunks(batch, "text"):
                    label = part.column(0).to_numpy().astype(np.int64)
                    for bucket, starts in grams(data, offsets, bits)[2]:
                        np.add.at(sums, (np.repeat(label, np.diff(starts)) << bits) + bucket, 1)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["cell", "n"])

        # at most CELLS rows, whatever the input
        found = sample.mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        counts.ravel()[found["cell"].to_numpy()] = found["n"].to_numpy()
    smooth = counts + 0.5
    prior = np.log(np.array([n for _, n in names], float) / max(1, sum(n for _, n in names)))
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32), prior, bits)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                best, score = m.tell(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return slim.mapInArrow(work, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of the documents that aren't held out."""
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, languages: tuple[str, ...] | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows, with all their columns, whose text is told to be in one of `languages` (any learned one if None) with a
    score of `least` or more; `lang` becomes that language. Where no row has a label, nothing can be told but whether a text
    has a letter: those texts stay, with `lang` null."""
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, None], dtype=object)
        wanted = np.array([languages is None or x in languages for x in m.languages] + [False])
        for batch in batches:
            for part, data, offsets in text_chunks(batch, batch.schema.names[at]):
                stays = ~np.asarray(part.column(at).is_null())
                if m.languages:
                    best, score = m.tell(data, offsets)
                    stays &= wanted[best] & (score >= least)
                    columns = list(part.columns)
                    columns[lang_at] = pa.array(names[best].tolist(), pa.string()).cast(columns[lang_at].type)
                    part = pa.RecordBatch.from_arrays(columns, part.schema.names)
                else:
                    stays &= grams(data, offsets)[1]
                yield part.filter(pa.array(stays))

    return docs.mapInArrow(work, docs.schema)
