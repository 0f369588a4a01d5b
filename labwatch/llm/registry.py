"""The queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labwatch.llm import fill_middle, line_dedup, mixing, multi_index, ngram_join, pii, quality_rules, secret_scan, sentencepiece_codec, suffix_dedup, token_counts, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_multi_index": multi_index.op4_multi_index,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op9_sentencepiece": sentencepiece_codec.op9_sentencepiece,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_pii": pii.op11_pii,
    "op12_whitening": whitening.op12_whitening,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}
SQL: dict[str, str] = {"op2_quality_rules": quality_rules.sql(), "op10_ngram_join": ngram_join.SQL, "op11_pii": pii.sql(), "op13_fill_middle": fill_middle.SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
