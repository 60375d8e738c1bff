"""One query per operator, over whole tables, and the same as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm import (
    conversations, exact_dedup, knn, lang_id, lm_score, mixing, oracles, packing, pii, resampling,
    sharding, simhash, token_files, url_filter,
)

SHARDS = 16
#: Host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

ORACLES: dict[str, str] = {
    "op1_lm_score": oracles.LM_SCORE,
    "op3_exact_top_k": oracles.TOP_K,
    "op5_source_mix": oracles.SOURCE_MIX,
    "op7_url_filter": oracles.url_filter(URL_RULES),
    "op8_sharding": oracles.SHARDING,
    "op9_exact_dedup": oracles.EXACT_DEDUP,
    "op13_resampling": oracles.RESAMPLING,
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def every(key: str, n: int) -> Column:
    return F.pmod(F.col(key), F.lit(n)) == 0


@query
def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.scores(read(spark, folder, "documents"))


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return lang_id.identified(read(spark, folder, "documents"))


@query
def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return knn.top_k(read(spark, folder, "embeddings"), every("id", 20), k=20)


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(read(spark, folder, "documents"), tokenizer_path()))


@query
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).drop("mark", "copies")


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii(read(spark, folder, "documents"))


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(read(spark, folder, "pages"), rules)


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(
        read(spark, folder, "documents"),
        sharding.regular_tree(SHARDS), sharding.regular_tree(SHARDS + 1),
    )


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, folder, "documents"))


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(read(spark, folder, "documents")).drop("mark")


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(read(spark, folder, "conversations"))


@query
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.through_files(read(spark, folder, "documents"), tokenizer_path())


@query
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
