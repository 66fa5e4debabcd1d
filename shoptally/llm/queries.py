"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoptally.llm import (
    fingerprints,
    html_text,
    licences,
    mixing,
    near_dups,
    packing,
    prefix_trie,
    quality_rules,
    resampling,
    secrets,
    suffix_dedup,
    token_counts,
    toxicity,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": lambda spark, sf: suffix_dedup.report(_read(spark, sf, "documents")),
    "op2_document_fingerprints": lambda spark, sf: fingerprints.report(_read(spark, sf, "documents")),
    "op3_quality_rules": lambda spark, sf: quality_rules.report(_read(spark, sf, "documents")),
    "op4_token_counts": lambda spark, sf: token_counts.report(_read(spark, sf, "documents")),
    "op5_toxicity": lambda spark, sf: toxicity.report(_read(spark, sf, "documents"), _read(spark, sf, "labels")),
    "op6_secret_scans": lambda spark, sf: secrets.report(_read(spark, sf, "documents")),
    "op7_near_dups": lambda spark, sf: near_dups.report(_read(spark, sf, "documents")),
    "op8_html_extraction": lambda spark, sf: html_text.main_texts(_read(spark, sf, "pages")),
    "op9_mixing": lambda spark, sf: mixing.report(_read(spark, sf, "documents")),
    "op10_packing": lambda spark, sf: packing.pack(_read(spark, sf, "documents")),
    "op11_importance_resampling": lambda spark, sf: resampling.report(
        _read(spark, sf, "documents"), _read(spark, sf, "benchmark")
    ),
    "op12_licence_scans": lambda spark, sf: licences.report(_read(spark, sf, "documents")),
    "op13_conversation_trie": lambda spark, sf: prefix_trie.report(_read(spark, sf, "conversations")),
}

ORACLES: dict[str, str] = {
    "op3_quality_rules": quality_rules.report_sql(),
    "op9_mixing": mixing.report_sql(),
    "op11_importance_resampling": resampling.report_sql(),
    "op13_conversation_trie": prefix_trie.report_sql(),
}
