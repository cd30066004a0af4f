"""Registered queries of this subpackage and the DuckDB statements that restate them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import alignment, ann, exact, hardneg, html_extract, langid, minhash, mixing, oracles, packing, pii, sharding, substring, vectors
from gazette.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(hardneg.scaled(table(spark, sf_dir, "embeddings")))


def op12_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_mixing, op3_near_dedup, op4_exact_dedup, op5_html_text, op6_packing, op7_vector_dedup, op8_langid,
    op9_substring, op10_sharding, op11_hard_negatives, op12_ann,
    op13_alignment)}

ORACLE = {
    "op1_pii": oracles.PII,
    "op4_exact_dedup": oracles.EXACT,
    "op7_vector_dedup": oracles.VECTORS,
    "op10_sharding": oracles.SHARDING,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
}
