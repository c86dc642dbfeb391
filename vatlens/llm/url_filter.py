"""Operator 7, URL filter by the ratio of two character language models.

Accepted and rejected URLs each train a smoothed variable-order Markov model of their
characters (Witten-Bell over contexts of up to ``order`` symbols). A URL's score is the
difference of its log-likelihoods divided by its length: bits a character by which the
rejected model fits better. The threshold is calibrated on a fold of the labelled URLs
that did not train: the midpoint of the score cell with the highest balanced accuracy.

Labels come from rules (host, path; a rule fits its host and all subdomains if the
path starts with the rule's; the longest fitting rule wins) and, for URLs without a
rule, from a short list of host terms that such lists commonly reject. Rules always
decide their URLs; the model decides all others. Only host and path are scored; the
scheme, query and fragment say nothing about a site.

A NULL URL or one without :// has an empty host and path, no rule, and is accepted:
there is nothing against it. The rules must not repeat a (host, path).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vatlens.llm.byte_context import ContextModel, count_contexts, freeze, gains, interpolate, unheld, whole_levels
from vatlens.llm.common import LOWER, UPPER, discard, materialise

#: The rules of the registered query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Fixed: host terms whose sites the seed list rejects.
REJECTED_TERMS = ["adult", "bet", "bets", "betting", "bonus", "casino", "cheap", "crack", "escort", "free", "gambling",
                  "jackpot", "keygen", "loan", "loans", "lottery", "nude", "pharma", "pills", "poker", "porn", "sex",
                  "slots", "torrent", "viagra", "warez", "webcam", "win", "xxx"]
#: Symbols of a context, deepest nodes that each class may name for the table of every task (its most frequent; the rest are
#: joined), least count of a node, folds.
ORDER, NODES, LEAST, FOLDS = 4, 20_000, 4, 5
CELLS = 4000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL without one."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):      # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, _rule_verdict, _site): the parts of every URL."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_rule_verdict"),
                        F.concat("host", "path").alias("text"))


def labelled(sites: DataFrame, terms: list[str] = REJECTED_TERMS) -> DataFrame:
    """(label, text, _held): 1 rejected, 0 accepted. A rule decides; without one, a host part equal to a term rejects."""
    listed = F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*map(F.lit, terms)))
    label = F.when(F.col("_rule_verdict") == "allow", 0).when((F.col("_rule_verdict") == "block") | listed, 1).otherwise(0)
    return sites.where("host <> ''").select(label.alias("label"), "text", (F.crc32("text") % FOLDS == 0).alias("_held"))


def learn(urls: DataFrame, order: int = ORDER, nodes: int = NODES, least: int = LEAST) -> ContextModel:
    counts, rest = whole_levels(count_contexts(urls, "url", order), "url", order, nodes, least)
    model = freeze("url", order, 2, counts, interpolate, parents=rest is not None)
    if rest is None:
        return model
    table = materialise(gains(rest, model, interpolate), "gains")
    discard(rest)
    return replace(model, parents=None, rest=table)


def scored(urls: DataFrame, model: ContextModel) -> DataFrame:
    """``urls`` plus _score, bits a character for rejection."""
    shared = urls.sparkSession.sparkContext.broadcast(replace(model, rest=None))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            bits = shared.value.lengths(column)
            chars = np.array([max(1, len(x.as_py() or "")) for x in column], float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((bits[:, 0] - bits[:, 1]) / chars)], names=[*batch.schema.names, "_score"])

    out = urls.mapInArrow(score, T.StructType([*urls.schema, T.StructField("_score", T.DoubleType())]))
    if model.rest is None:
        return out
    more = F.coalesce("_more", F.lit(0.0)) / F.greatest(F.char_length("text"), F.lit(1))
    return out.join(corrections(urls, model), "text", "left").select(*urls.columns, (F.col("_score") + more).alias("_score"))


def corrections(urls: DataFrame, model: ContextModel) -> DataFrame:
    """(text, _more): what the contexts beyond the table of every task add to a text's bits for rejection, each distinct
    text once. They join the places that read them, and a text's are summed in the order of its bytes."""
    texts = materialise(urls.where("text <> ''").select("text").distinct().withColumn("id", F.monotonically_increasing_id()), "texts")
    bits = F.col("gain")[(F.col("symbol") * 2).cast("int")] - F.col("gain")[(F.col("symbol") * 2 + 1).cast("int")]
    found = unheld(texts, model).join(model.rest, "context").select("id", F.struct("place", bits.alias("bits")).alias("_at"))
    total = F.aggregate(F.array_sort(F.collect_list("_at")), F.lit(0.0), lambda s, x: s + x["bits"])
    return found.groupBy("id").agg(total.alias("_more")).join(texts, "id").select("text", "_more")


def calibrate(held: DataFrame) -> float:
    """The threshold with the highest balanced accuracy over ``held`` (label, _score): scores are
    counted in cells of 1/200 bit from -10 to 10 (a table of bounded size), then scanned."""
    cell = F.least(F.greatest(F.floor(F.col("_score") * 200) + CELLS // 2, F.lit(0)), F.lit(CELLS - 1)).cast("int")
    got = held.groupBy("label", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    hist = np.zeros((2, CELLS))
    hist[got["label"], got["_cell"]] = got["n"]
    if not hist.sum(1).all():
        return 0.0
    good = np.concatenate([[0], hist[0].cumsum()]) / hist[0].sum()       # accepted below each cut
    bad = 1 - np.concatenate([[0], hist[1].cumsum()]) / hist[1].sum()    # rejected at or above it
    best = np.flatnonzero(np.isclose(good + bad, (good + bad).max()))
    return float((best[len(best) // 2] - CELLS // 2) / 200)


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, terms: list[str] = REJECTED_TERMS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page."""
    sites = parsed(pages, rules)
    urls = labelled(sites, terms)
    model = learn(urls.where("not _held"))
    limit = calibrate(scored(urls.where("_held"), model))
    ruled = scored(sites, model)
    method = F.when((F.col("host") != "") & (F.col("_score") >= limit), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "rule", F.coalesce("_rule_verdict", method).alias("verdict"),
                        F.col("_score").alias("score"))
