"""Operator 8, quality rules by robust multivariate outliers. DataFrame and SQL functions only.

Every text gives a vector of transformed statistics. For each (lang, source) group the
minimum-covariance-determinant estimate of location and scatter is found by concentration steps:
distances are taken, the share ``core`` of the rows with the smallest distances gives the next mean and
covariance, and so on. There are two starts, the medians with the floors as scale and the mean and covariance of
all rows; a group goes on while its determinant falls (``STEPS`` at most, else a warning), and of all cores the
one with the least determinant stays. Its covariance is made consistent with the normal law by the usual
factor. A document is rejected if the hard rules fail or its squared Mahalanobis distance passes
``cutoff``. Scatter is regularised by a floor per statistic: most statistics of clean text
are constant zero, and a difference below the floor says nothing.

Each step is one aggregation. Rows are counted with their moments per (group, cell of the
distance), so the step's quantile and its moments come from one small table (a core takes whole cells);
statistics are scaled integers, so sums are exact and the result does not depend on task order. Matrices are
inverted as arrays, by sweeping one pivot after the other. Groups of fewer than ``min_group`` rows use their
language's estimate, and those of their language if that is small too the estimate of all rows. A hot group is
combined on the map side.

NULL lang and source are values of their own. A NULL text has no words and fails.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vatlens.llm.common import BROADCAST_ROWS, UPPER, materialise, small

#: Share of rows in the core; squared distance that rejects; rows below which a group is too small.
CORE, CUTOFF, MIN_GROUP, STEPS = 0.75, 30.0, 50, 40
#: A step that lowers the logarithm of the determinant by less ends a group's steps.
SETTLED = 1e-6
#: Words in a window, rules of the base.
WINDOW, MIN_WORDS, REPEAT_PERCENT = 8, 20, 30
#: Least standard deviation of each statistic: word length (log2), then square roots of the shares of
#: symbols, capitals and other marks, of repeated lines, of words in repeated windows, and of words
#: equal to the next.
FLOORS = {"length": 0.20, "symbols": 0.10, "capitals": 0.12, "marks": 0.12, "lines": 0.20, "repeats": 0.20, "runs": 0.12}
#: Statistics are counted in units of 1 / SCALE; distances in cells of 1 / 8.
SCALE, CELLS = 512, 2048
#: Characters that are counted, and white space as a pattern.
SYMBOLS, MARKS, WHITE = "#*$%&|<>", "!?;:=+_~^@/\\", r"[\x20\x09-\x0D]+"


def counted(chars: str) -> Column:
    """How many characters of ``_special`` are in ``chars``."""
    return F.length("_special") - F.length(F.translate("_special", chars, ""))


def base_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, lang, source (and ``keep``) with the five counts and what the vector needs more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", "source", *keep, text.alias("_text"))
    # a short text of the characters that are counted, and nothing else
    others = "[^A-Z" + "".join("\\" + c for c in SYMBOLS + MARKS) + "]+"
    d = d.withColumns({"_words": F.filter(F.split("_text", WHITE), lambda w: w != ""),
                       "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                       "_special": F.regexp_replace("_text", others, "")})
    # the windows of 8 words as 64-bit hashes, in reading order: of pairs, of pairs of those, and of pairs again
    d = d.withColumns({"n_words": F.size("_words").cast("long"), "_hash": F.transform("_words", lambda w: F.xxhash64(w))})
    d = d.withColumn("_windows", doubled("_hash", 1))
    for step in range(1, WINDOW.bit_length() - 1):
        d = d.withColumn("_windows", doubled("_windows", 1 << step))
    return d.select(
        "doc_id", "lang", "source", *keep, "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), counted(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words().cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"), counted(UPPER).alias("_capitals"), counted(MARKS).alias("_marks"),
        F.size(F.filter("_hash", lambda h, i: h == F.get("_hash", i + 1))).alias("_runs"))


def doubled(column: str, gap: int) -> Column:
    """Hashes of stretches twice as long: of each entry with that ``gap`` places on, as far as there is one."""
    ahead = F.slice(column, gap + 1, F.greatest(F.size(column) - gap, F.lit(0)))
    return F.zip_with(F.slice(column, 1, F.greatest(F.size(column) - gap, F.lit(0))), ahead, lambda a, b: F.xxhash64(a, b))


def repeated_words() -> Column:
    """Words that lie in a window found at least twice. Windows are sorted by (hash, place); equal
    neighbours are repeated; the places of those, in order, cover min(8, gap to the next) words each."""
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size("_windows")

    def places(sorted_pairs: Column) -> Column:
        def hash_at(k):
            return F.get(sorted_pairs, k)["h"]
        hit = F.transform(sorted_pairs, lambda p, k: F.when((p["h"] == hash_at(k - 1)) | (p["h"] == hash_at(k + 1)), p["i"]))
        return F.sort_array(F.filter(hit, lambda x: x.isNotNull()))

    def covered(at: Column) -> Column:
        width = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(width, F.lit(0), lambda a, x: a + x)

    # one-element transforms bind an intermediate value to a name, so that it is computed once
    counted = F.transform(F.transform(F.array(pairs), places), covered)
    return F.when(F.size(F.array_distinct("_windows")) == last, F.lit(0)).otherwise(F.get(counted, F.lit(0)))


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def vector() -> dict[str, Column]:
    """The transformed statistics, as integers in units of 1 / SCALE."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def root(part: Column, whole: Column) -> Column:
        return F.sqrt(F.least(part / whole, F.lit(16.0)))

    raw = {
        "length": F.least(F.log2(1 + F.col("word_chars") / words), F.lit(6.0)),
        "symbols": root(F.col("n_symbols"), words),
        "capitals": root(F.col("_capitals"), F.greatest(F.col("word_chars"), F.lit(1))),
        "marks": root(F.col("_marks"), words),
        "lines": root(F.col("n_dup_lines"), F.greatest(F.col("_n_lines"), F.lit(1))),
        "repeats": root(F.col("n_repeat_words"), words),
        "runs": root(F.col("_runs"), words),
    }
    return {f"_x_{k}": F.round(c * SCALE).cast("long") for k, c in raw.items()}


NAMES = [f"_x_{k}" for k in FLOORS]
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


SIZE = len(FLOORS)


def distance() -> Column:
    """Squared Mahalanobis distance from the mean ``_m`` by the inverse covariance ``_p``, an array of rows."""
    gap = [f"({x} / {SCALE}D - _m[{i}])" for i, x in enumerate(NAMES)]
    rows = [f"{gap[i]} * (" + " + ".join([f"_p[{i * SIZE + i}] * {gap[i]}"] + [f"2 * _p[{i * SIZE + j}] * {gap[j]}" for j in range(i)]) + ")" for i in range(SIZE)]
    return F.expr(f"greatest({' + '.join(rows)}, 0D)")


def chi_square(x: float, freedom: int) -> float:
    """Its distribution function, by the series of the incomplete gamma function."""
    a, z = freedom / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= z / k
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a))


def consistency(core: float, size: int = SIZE) -> float:
    """What the covariance of the inner share ``core`` of a normal sample is multiplied by to be that of all."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, size) < core else (low, middle)
    return core / chi_square(high, size + 2)


def estimated(moments: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """keys, _rows, _n, _m (means), _p (inverse of the regularised covariance times ``factor``, by rows) and _logdet."""
    floors, last = [f ** 2 for f in FLOORS.values()], SIZE * SIZE
    square = SCALE ** 2
    d = moments.selectExpr(*keys, "_rows", "_n", f"array({', '.join(f'_s{i} / CAST(_n AS DOUBLE) / {SCALE}' for i in range(SIZE))}) AS _m",
                           f"array({', '.join(f'_q{max(i, j)}_{min(i, j)} / CAST(_n AS DOUBLE) / {square}' for i in range(SIZE) for j in range(SIZE))}) AS _q")
    entry = [f"(_q[{i * SIZE + j}] - _m[{i}] * _m[{j}]) * {factor!r}D + {floors[i] if i == j else 0.0!r}D" for i in range(SIZE) for j in range(SIZE)]
    # one pivot k after the other; the last element adds up the logarithms of the pivots
    least = f"array({', '.join(f'{f / 4!r}D' for f in floors)})"
    pivot = f"greatest(a[k * {SIZE + 1}], {least}[k])"
    i, j = f"(at DIV {SIZE})", f"(at % {SIZE})"
    sweep = f"""aggregate(sequence(0, {SIZE - 1}), _a, (a, k) -> transform(a, (x, at) ->
        CASE WHEN at = {last} THEN x + ln({pivot}) WHEN {i} = k AND {j} = k THEN -1 / {pivot} WHEN {i} = k OR {j} = k THEN x / {pivot}
             ELSE x - a[CAST({i} AS INT) * {SIZE} + k] * a[k * {SIZE} + {j}] / {pivot} END))"""
    return d.selectExpr(*keys, "_rows", "_n", "_m", f"array({', '.join(entry)}, 0D) AS _a").selectExpr(*keys, "_rows", "_n", "_m", f"{sweep} AS _a") \
        .selectExpr(*keys, "_rows", "_n", "_m", f"transform(slice(_a, 1, {last}), x -> -x) AS _p", f"_a[{last}] AS _logdet")


KEYS = ["_level", "_lang", "_source"]


def levelled(stats: DataFrame) -> DataFrame:
    """Each row in its three groups: (lang, source), (lang), all."""
    lang, source = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    return stats.select(F.explode(F.sequence(F.lit(0), F.lit(2))).alias("_level"), lang.alias("_lang"), source.alias("_source"), *NAMES) \
        .withColumn("_lang", F.when(F.col("_level") < 2, F.col("_lang")).otherwise("")) \
        .withColumn("_source", F.when(F.col("_level") < 1, F.col("_source")).otherwise(""))


def moments() -> list[Column]:
    return [F.expr("count(1) AS _n"), *[F.expr(f"sum({x}) AS _s{i}") for i, x in enumerate(NAMES)],
            *[F.expr(f"sum({NAMES[i]} * {NAMES[j]}) AS _q{i}_{j}") for i, j in PAIRS]]


def core_moments(rows: DataFrame, keys: list[str], cell: Column, core: float) -> DataFrame:
    """Per group: size ``_rows`` and the moments of the cells up to the one that reaches ``core``."""
    group = Window.partitionBy(*keys)
    cells = rows.groupBy(*keys, cell.alias("_cell")).agg(*moments())
    cells = cells.withColumns({"_rows": F.sum("_n").over(group), "_before": F.sum("_n").over(
        group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))})
    inner = cells.where(F.coalesce("_before", F.lit(0)) < F.ceil(core * F.col("_rows")))
    sums = ["_n", *[f"_s{i}" for i in range(SIZE)], *[f"_q{i}_{j}" for i, j in PAIRS]]
    return inner.groupBy(*keys).agg(F.first("_rows").alias("_rows"), *[F.expr(f"sum({c}) AS {c}") for c in sums])


def cores(stats: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """(_level, _lang, _source, _rows, _m, _p, _logdet): of every group the core of least determinant."""
    rows, factor = levelled(stats), consistency(core)

    def cell(squared: Column) -> Column:
        return F.least(F.floor(F.sqrt(squared) * 8), F.lit(CELLS)).cast("int")

    # first start: the core around the median of every statistic, in units of the floors
    middle = materialise(rows.groupBy(*KEYS).agg(*[F.percentile(x, 0.5).alias(f"_p{i}") for i, x in enumerate(NAMES)]), "middle")
    few = 2 * middle.count() <= BROADCAST_ROWS          # of the states below, too: a row for each group and start

    def bounded(groups: DataFrame) -> DataFrame:
        return F.broadcast(groups) if few else groups

    away = reduce(Column.__add__, [F.pow((F.col(x) - F.col(f"_p{i}")) / (SCALE * f), 2) for i, (x, f) in enumerate(zip(NAMES, FLOORS.values()))])
    first = core_moments(rows.join(bounded(middle), KEYS), KEYS, cell(away), core)
    # second start: the mean and covariance of all rows
    whole = rows.groupBy(*KEYS).agg(*moments()).withColumn("_rows", F.col("_n"))
    starts = first.withColumn("_start", F.lit(0)).unionByName(whole.withColumn("_start", F.lit(1)))
    keys = [*KEYS, "_start"]
    left = materialise(estimated(starts, keys, factor), "mcd")
    tried = [left.where("_start = 0")]                  # all rows are no core
    for _ in range(steps):
        was = left.select(*keys, "_m", "_p", F.col("_logdet").alias("_was"))
        after = estimated(core_moments(rows.join(bounded(was), KEYS), keys, cell(distance()), core), keys, factor)
        after = materialise(after.join(bounded(was.select(*keys, "_was")), keys), "mcd")
        tried.append(after.drop("_was"))
        left = after.where(F.col("_logdet") < F.col("_was") - SETTLED).drop("_was")
        if left.isEmpty():
            break
    else:
        warnings.warn(f"quality rules: {left.count()} groups still had a smaller determinant after {steps} steps", stacklevel=2)
    every = reduce(DataFrame.unionByName, tried)
    return materialise(every.groupBy(*KEYS).agg(F.min_by(F.struct("_rows", "_m", "_p", "_logdet"), F.struct("_logdet", "_n")).alias("_e"))
                       .select(*KEYS, "_e.*"), "cores")


def estimates(stats: DataFrame, core: float = CORE, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """(_lang, _source, _m, _p) for every (lang, source) present."""
    current = cores(stats, core, steps)
    by = {k: current.where(f"_level = {k}").select("_lang", "_source", "_rows", F.struct("_m", "_p").alias(f"_e{k}")) for k in range(3)}
    lang = by[1].select("_lang", F.col("_rows").alias("_n1"), "_e1")
    chosen = by[0].join(lang, "_lang").crossJoin(F.broadcast(by[2].select("_e2")))     # one row
    best = F.when(F.col("_rows") >= min_group, F.col("_e0")).when(F.col("_n1") >= min_group, F.col("_e1")).otherwise(F.col("_e2"))
    return materialise(chosen.select("_lang", "_source", best.alias("_e")).select("_lang", "_source", "_e.*"), "estimates")


def judged(stats: DataFrame, est: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with base_failed, distance and kept."""
    keyed = stats.withColumns({"_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), "_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))})
    d = keyed.join(small(est), ["_lang", "_source"], "left").withColumns({"base_failed": failed(), "distance": distance()})
    return d.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("distance") > cutoff, F.lit(False)))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    return base_statistics(docs, *keep).withColumns(vector())


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance)."""
    stats = materialise(statistics(docs), "statistics")
    return judged(stats, estimates(stats), cutoff).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                          "base_failed", "kept", "distance")


def drop_rejected(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without the rows that ``quality_rules`` rejects, all columns kept. The statistics of a
    row are computed again next to it, so no text is shuffled."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: names[i] for i, c in reversed(list(enumerate(docs.columns)))}
    flat = docs.toDF(*names)
    read = flat.select(*[F.col(at[c]).alias(c) for c in ("doc_id", "text", "lang", "source")], F.struct(*names).alias("_row"))
    est = estimates(materialise(statistics(read), "statistics"))
    # the row number keeps the optimizer from copying the statistics' expressions into the filter
    again = statistics(read, "_row").withColumn("_fence", F.monotonically_increasing_id())
    return judged(again, est, cutoff).where(F.col("kept") & (F.col("_fence") >= 0)).select("_row.*").toDF(*docs.columns)
