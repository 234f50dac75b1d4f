"""The operators applied to whole tables, as named queries, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import jaccard, language, mixing, packing, preference, quality, repair, scoring, simhash, substring, tokens, topk, trie


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": lambda spark, d: mixing.digest(_documents(spark, d)),
        "op2_quality_rules": lambda spark, d: quality.digest(_documents(spark, d)),
        "op3_jaccard_join": lambda spark, d: jaccard.digest(_documents(spark, d)),
        "op4_exact_top_k": lambda spark, d: topk.digest(spark.read.parquet(f"{d}/embeddings.parquet")),
        "op5_substring_dedup": lambda spark, d: substring.digest(_documents(spark, d)),
        "op6_preference_format": lambda spark, d: preference.digest(spark.read.parquet(f"{d}/conversations.parquet")),
        "op6_preference_shared": lambda spark, d: preference.digest_shared(spark.read.parquet(f"{d}/conversations.parquet")),
        "op6_preference_pairs": lambda spark, d: preference.digest_pairs(spark.read.parquet(f"{d}/conversations.parquet")),
        "op7_language_id": lambda spark, d: language.digest(_documents(spark, d)),
        "op8_lm_scoring": lambda spark, d: scoring.digest(_documents(spark, d)),
        "op9_token_counts": lambda spark, d: tokens.digest(_documents(spark, d)),
        "op10_packing": lambda spark, d: packing.digest(_documents(spark, d)),
        "op11_simhash": lambda spark, d: simhash.digest(_documents(spark, d)),
        "op12_conversation_repair": lambda spark, d: repair.digest(spark.read.parquet(f"{d}/conversations.parquet")),
        "op13_prefix_trie": lambda spark, d: trie.digest(spark.read.parquet(f"{d}/conversations.parquet")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_jaccard_join": jaccard.ORACLE_SQL,
        "op4_exact_top_k": topk.ORACLE_SQL,
        "op5_substring_dedup": substring.ORACLE_SQL,
        "op6_preference_format": preference.ORACLE_SQL,
        "op6_preference_shared": preference.SHARED_SQL,
        "op6_preference_pairs": preference.PAIRS_SQL,
        "op12_conversation_repair": repair.oracle_sql(trie.CRC32),
        "op13_prefix_trie": trie.ORACLE_SQL,
    }
