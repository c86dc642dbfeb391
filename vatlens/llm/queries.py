"""The registered queries of this package: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vatlens.llm import (exact_dedup, hard_negatives, language_id, line_dedup, lm_scoring, mixing, ngram_join, packing, periodic_runs,
                         quality, sharding, toxicity, url_filter)
from vatlens.llm.common import table


def over_documents(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": over_documents(language_id.held_out_languages),
    "op2_mixing": over_documents(mixing.mix),
    "op3_packing": over_documents(packing.pack),
    "op4_toxicity": lambda spark, sf_dir: toxicity.held_out_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op5_lm_scoring": over_documents(lm_scoring.held_out_scores),
    "op6_line_dedup": over_documents(line_dedup.line_dedup),
    "op7_url_filter": lambda spark, sf_dir: url_filter.url_filter(table(spark, sf_dir, "pages")),
    "op8_quality_rules": over_documents(quality.quality_rules),
    "op9_ngram_join": over_documents(ngram_join.ngram_join),
    "op10_exact_dedup": over_documents(exact_dedup.exact_dedup),
    "op11_sharding": over_documents(sharding.sharding),
    "op12_periodic_runs": over_documents(periodic_runs.document_runs),
    "op13_hard_negatives": lambda spark, sf_dir: hard_negatives.mined_embeddings(table(spark, sf_dir, "embeddings")),
}

ORACLE: dict[str, str] = {
    "op6_line_dedup": line_dedup.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_sharding": sharding.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
