"""From raw documents to packed sequences.

Each stage takes the documents its predecessor kept, whole, and all but the last
return the columns of documents.  SQL cannot express language identification
or tokenizers, so ``ORACLE_SQL`` is None; the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kontor.llm import exact_dedup, lang_id, mixing, packing, queries, simhash
from kontor.session import stored

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; those without any letter go."""
    return lang_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of largest id, of those with equal texts."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest id, of each group of near duplicates."""
    return simhash.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences."""
    return packing.digest(packing.pack(docs, queries.tokenizer_path()))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs)
    return docs
