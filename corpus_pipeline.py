"""The corpus pipeline: five stages over ``documents``, each written as a table and read by the next.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The
first four return whole rows of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vatlens.llm import exact_dedup, mixing, ngram_join, packing, quality
from vatlens.llm.common import materialise, table

#: Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 (the query op9: three words, 0.9).
NEAR_SHINGLE, NEAR_PERCENT = 5, 80

STAGES = [
    ("quality_rules", lambda spark, docs, sf_dir: quality.drop_rejected(docs)),
    ("exact_dedup", lambda spark, docs, sf_dir: exact_dedup.drop_copies(docs)),
    ("ngram_jaccard_join", lambda spark, docs, sf_dir: ngram_join.drop_near_copies(docs, NEAR_SHINGLE, NEAR_PERCENT)),
    ("mixing", lambda spark, docs, sf_dir: mixing.sample(docs)),
    ("best_fit_packing", lambda spark, docs, sf_dir: packing.pack(docs)),
]

#: Robust estimates and sequential packing have no SQL form; a test holds run()'s rows against plain
#: versions of the stages, but for the robust verdict of the quality stage, which it takes from op8.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
