"""Operator 2, mixing sources to target weights by iterative proportional fitting. DataFrame and SQL only.

Documents are counted into cells (source, language, topic) with their tokens. Each cell
carries one inclusion probability. Raking repeats, margin by margin: the expected tokens
of every margin value are compared with its target, and the probabilities of its cells
are multiplied by the ratio (never above 1), until nothing moves. A document is then
sampled if the hash of its id, as a number in [0, 1), lies below its cell's probability,
so the choice does not depend on partitions or on the order of the rows.

Targets: a share per value of a margin, or by default the corpus share to the power
``temper``, which lifts small sources and lowers large ones. Values that given targets do
not name get nothing. ``rate`` is the share of all
tokens to keep. Only the cell table, which is small (sources x languages x topics), is
raked; every round is one table in the shared folder. Texts are read once and not moved.

NULL source, lang and text (the empty text) are values of their own. Rows that repeat a
doc_id share its fate. A margin value without tokens keeps its probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vatlens.llm.common import materialise, small

MARGINS = ("source", "lang", "topic")
RATE, TEMPER = 0.7, 0.9
ROUNDS, TOLERANCE = 25, 1e-4
SEED = 17


def token_count(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A topic where the corpus names none: the form of the text, by cell marks and length."""
    marks = F.coalesce(F.length(text) - F.length(F.translate(text, "|\t", "")), F.lit(0))
    return F.when(tokens == 0, "empty").when(marks * 5 > tokens, "table").when(tokens < 100, "note") \
        .when(tokens < 1000, "article").otherwise("book")


def placed(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the margins, n_tokens (and ``keep``); margin keys that tell NULL from text."""
    d = docs.withColumn("n_tokens", token_count(F.col("text")))
    d = d.select("doc_id", "source", "lang", topic_of(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens", *keep)
    return d.withColumns({f"_{m}": F.coalesce(F.concat(F.lit("="), F.col(m)), F.lit("")) for m in MARGINS})


def with_targets(cells: DataFrame, targets: dict[str, dict[str | None, float]], temper: float) -> DataFrame:
    """Cells with the target share of each of their margin values as _t_<margin>."""
    for m in MARGINS:
        values = cells.groupBy(f"_{m}").agg(F.sum("_tokens").alias("_sum"))
        raw = F.lit(0.0) if m in targets else F.pow(F.col("_sum").cast("double"), F.lit(temper))
        for value, weight in targets.get(m, {}).items():
            raw = F.when(F.col(f"_{m}") == ("" if value is None else f"={value}"), F.lit(float(weight))).otherwise(raw)
        values = materialise(values.select(f"_{m}", raw.alias("_raw")), "margin")
        total = values.agg(F.sum("_raw")).first()[0]
        cells = cells.join(small(values), f"_{m}").withColumn(f"_t_{m}", F.col("_raw") / F.lit(total or 1.0)).drop("_raw")
    return cells


def rake(cells: DataFrame, targets: dict[str, dict[str | None, float]] | None = None, rate: float = RATE,
         temper: float = TEMPER, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (margin keys, _tokens) with probability."""
    total = cells.agg(F.sum("_tokens")).first()[0] or 0
    keys = [f"_{m}" for m in MARGINS]
    state = with_targets(cells, targets or {}, temper).withColumn("probability", F.lit(float(rate)))
    state = materialise(state.withColumn("_before", F.col("probability")), "cells")
    for _ in range(rounds):
        step = state.withColumn("_before", F.col("probability"))
        for m in MARGINS:
            now = F.sum(F.col("probability") * F.col("_tokens")).over(Window.partitionBy(f"_{m}").orderBy(*keys).rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing))
            step = step.withColumn("_now", now).withColumn("probability", F.when(F.col("_now") > 0, F.least(
                F.lit(1.0), F.col("probability") * F.col(f"_t_{m}") * F.lit(rate * total) / F.col("_now"))).otherwise(F.col("probability"))).drop("_now")
        state = materialise(step, "cells")
        moved = state.agg(F.max(F.abs(F.col("probability") - F.col("_before")))).first()[0]
        if moved is None or moved < tolerance:
            break
    return state.select(*keys, "probability")


def cells_of(rows: DataFrame) -> DataFrame:
    return materialise(rows.groupBy(*[f"_{m}" for m in MARGINS]).agg(F.sum("n_tokens").alias("_tokens")), "cells")


def draw(seed: int) -> Column:
    """The hash of a document's id as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)), 11) / F.lit(2.0 ** 53)


def mix(docs: DataFrame, targets: dict[str, dict[str | None, float]] | None = None, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, weight, sampled) per row; weight: the
    tokens that the row is expected to bring."""
    rows = materialise(placed(docs), "placed")
    p = rake(cells_of(rows), targets, rate)
    return rows.join(small(p), [f"_{m}" for m in MARGINS]).select(
        "doc_id", *MARGINS, "n_tokens", "probability", (F.col("probability") * F.col("n_tokens")).alias("weight"),
        (draw(seed) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, targets: dict[str, dict[str | None, float]] | None = None, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs``, all columns kept."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: names[i] for i, c in reversed(list(enumerate(docs.columns)))}
    flat = docs.toDF(*names)
    read = flat.select(*[F.col(at[c]).alias(c) for c in ("doc_id", "text", "lang", "source")], F.struct(*names).alias("_row"))
    p = rake(cells_of(placed(read)), targets, rate)
    return placed(read, "_row").join(small(p), [f"_{m}" for m in MARGINS]).where(draw(seed) < F.col("probability")).select("_row.*").toDF(*docs.columns)
