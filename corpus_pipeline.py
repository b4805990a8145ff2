"""A corpus from raw documents to token files: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelflens.llm import decontamination, mixing, simhash, tokencoding, toxicity
from shelflens.llm.common import save, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't predicted toxic; null and empty texts stay, repeated ids are judged by their own text."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id; rows are told apart by id and text, null and empty texts are alike."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark in their own text, whatever other rows have their doc_id or none; null and empty texts stay."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their source's target takes them, three times at most; a null source is a source, rows without words are kept once."""
    return mixing.mixture(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row's ids stand in the token files; null and empty texts have the end id only, repeated rows their own ids."""
    return tokencoding.op4_context_mixing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("token_ids", encode_tokens),
]

#: SQL can express neither the trained toxicity scores nor the byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, f"pipeline-{name}")
    return docs
