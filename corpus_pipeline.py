"""From raw documents to packed sequences: five stages, each one operator, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelloom.llm import decontaminate, packing, quality_rules, secret_scan, simhash_dedup
from panelloom.llm.queries import tokenizer_file
from panelloom.session import materialize


# Every stage gives an empty table for an empty one, carries other columns along as they are whatever their names, and
# judges repeated rows each for itself, but for near copies.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rule table. A null or empty text has no words and goes."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of fingerprints at most 2 bits apart (three-word shingles), nulls included.

    Repeated rows and texts without words are near copies of each other; any one row of a repeated smallest id stays.
    """
    return simhash_dedup.keep_one(docs, width=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less benchmark passages; those that are mostly benchmark go. Null and empty texts stay as they are."""
    return decontaminate.remove_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked. Null and empty texts stay as they are."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 tokens. A null or empty text is its end id."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Packing is beyond SQL; tests hold every stage against plain Python, whole rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
