"""A training corpus from documents: language ID, near-dedup, substring dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. Rows that a
stage does not judge (null ids in the dedup stages) pass it unchanged. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import language_id, mixing, packing, recompress, shingles
from roadloom.llm.common import Durable, ship, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language told with enough confidence, which becomes their lang; drops the others."""
    ship(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates (word 5-grams, similarity 0.8): candidates of the
    Gray-order SimHash index first, every link verified."""
    ship(spark)
    return shingles.keep_first(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that also stand in a document of a smaller id."""
    ship(spark)
    return recompress.apply(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents, so that sources come to their target weights."""
    ship(spark)
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 2048."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing, naive Bayes and the genetic algorithm have no SQL form; tests/llm/test_pipeline.py runs all stages on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = Durable(docs, f"stage-{name}").df
    return docs
