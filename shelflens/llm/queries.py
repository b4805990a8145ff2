"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blockdedup, bytededup, decontamination, dialogues, mixing, neighbours, packing, quality, retrieval, sharding, simhash, tokencoding, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op1_ordinal_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op2_external_shuffle(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencoding.op4_context_mixing(table(spark, sf_dir, "documents"))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op5_spaced_seeds(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockdedup.op6_block_anchors(table(spark, sf_dir, "documents"))


def op7_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytededup.op7_byte_repeats(table(spark, sf_dir, "documents"))


def op8_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.op8_prefix_forest(table(spark, sf_dir, "embeddings"))


def op9_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op9_entropy_mix(table(spark, sf_dir, "documents"))


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op11_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op11_mixture_packing(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.op12_lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.op13_audit_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality, op2_external_shuffle, op3_simhash, op4_context_mixing, op5_spaced_seeds,
        op6_block_anchors, op7_byte_repeats, op8_prefix_forest, op9_entropy_mix, op10_toxic_segments,
        op11_mixture_packing, op12_lexical_search, op13_audit_repair,
    )
}
