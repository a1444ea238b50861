"""Queries of this subpackage: opN_<name>, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import collocations, divergence, html_text, language_id, max_score, mixing, multi_index, packing, prefix_tokens, recompress, secret_scan, simhash, token_files
from .common import table
from .oracles import ORACLES


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2)


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_score.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.digest(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=10, top=10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), least=30, top=2000)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_token_ids, op2_html_text, op3_language_id, op4_simhash, op5_multi_index, op6_packing, op7_mixing, op8_max_score, op9_recompression, op10_token_counts, op11_divergence, op12_collocations, op13_secrets)
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
