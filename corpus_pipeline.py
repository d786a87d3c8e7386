"""A corpus from raw documents to packed training sequences, in stages that each write a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaylake.llm import linededup, minhash, packing, pii, quality, tokens
from quaylake.llm.common import prepared, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepared(spark)
    return quality.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand on many sites, but for one place of each line."""
    prepared(spark)
    return linededup.replaced(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash fingerprints of five-word shingles propose pairs by
    multi-index hashing, and those of similarity 0.8 or more are linked."""
    prepared(spark)
    return minhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    prepared(spark)
    return pii.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids (little-endian, unsigned, 32 bits), sequence and place."""
    prepared(spark)
    return packing.packed(tokens.pieces(docs, packing.CAPACITY))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

# Neither estimated probabilities, XXH64 nor the tokenizer's ids can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
