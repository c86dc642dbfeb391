"""Operator 1, language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``order`` symbols with escape
probabilities, counted over all learning texts and then frozen. A text's code length
under a language is the sum of -log2 of its symbols' probabilities; the language with
the shortest code is predicted, and the score is its posterior probability under equal
priors, 1 / sum 2**(shortest - length). Ties go to the alphabetically first language.

Only the text enters a prediction. A NULL text, or one without a letter, is ``und``
with score 0; so is every text if nothing can be learned (no text with a language).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.byte_context import ContextModel, count_contexts, escape, freeze, levels
from vatlens.llm.common import fold

#: Symbols of a context, nodes a depth that each language may name (its most frequent), and least count of a node.
ORDER, NODES, LEAST = 3, 6000, 16


def learn(texts: DataFrame, order: int = ORDER, nodes: int = NODES, least: int = LEAST) -> tuple[list[str], ContextModel]:
    """The languages and the frozen model of ``texts`` (text, lang); rows without either teach nothing."""
    texts = texts.where("text is not null and lang is not null")
    langs = sorted(r[0] for r in texts.select("lang").distinct().collect())
    known = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)]) if langs else None
    if not langs:
        return [], None
    labelled = texts.select(known[F.col("lang")].alias("label"), "text")
    counts = levels(count_contexts(labelled, "text", order), "text", order, nodes, least)
    return langs, freeze("text", order, len(langs), counts, escape)


def identify(docs: DataFrame, langs: list[str], model: ContextModel | None) -> DataFrame:
    """``docs`` (any columns, with text) plus lang_pred and score."""
    texts = docs.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    others = [c for c in docs.columns if c != "text"]
    out = docs.select(*others).schema.add("lang_pred", "string").add("score", "double")
    if not langs:
        return docs.select(*others, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = np.array(langs, dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = shared.value.lengths(batch.column("text"))
            letters = batch.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            best = bits.argmin(1)
            score = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            found = [pa.array(np.where(letters, names[best], "und"), pa.string()), pa.array(np.where(letters, score, 0.0))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + found, names=[*others, "lang_pred", "score"])

    return texts.select(*others, "text", "_letters").mapInArrow(predict, out)


def held_out_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the folds that are not held out."""
    out = fold("doc_id", 3) == 1
    langs, model = learn(docs.where(~out).select("text", "lang"))
    return identify(docs.select("doc_id", out.alias("held_out"), "text"), langs, model)
