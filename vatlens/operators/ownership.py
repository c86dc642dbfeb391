"""2.1 Ownership mesh and opacity ("dark matter") propagation.

Opacity of a company is the capital-weighted mean of its partners' values,
defined only when every partner has a value. Seeds give natural persons a
value; a company's value, once defined, is final, so the set of resolved
companies only grows and the loop can stop as soon as a round adds none.

Per round the plan is: averaged mesh (salted on hot partners, bucketed on (partner, salt)
once) joined to the newly resolved companies on partner, then one aggregate by company. Only the
frontier and what it sends moves in a round; a person or holding that is partner of a
third of all companies is spread over all tasks.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vatlens.functions.expr import safe_div
from vatlens.plans.iterate import LoopTrace, cut, cut_partitioned, observed
from vatlens.plans.skew import SALT, find_hot_keys, salt_big, salt_keys, salt_small


def own_profile(own: DataFrame) -> DataFrame:
    """Data-quality counts of an ownership table: a chain of three aggregates
    (exact row groups -> (company, partner) pairs -> one row), no join."""
    cap, prof = F.col("capital"), F.col("profit")
    flags = {
        "null_shares": cap.isNull() | prof.isNull(),
        "zero_either": (cap == 0) | (prof == 0),
        "zero_both": (cap == 0) & (prof == 0),
        "zero_capital_only": (cap == 0) & (prof != 0),
        "zero_profit_only": (cap != 0) & (prof == 0),
        "out_of_range": (cap < 0) | (cap > 100) | (prof < 0) | (prof > 100),
        "nonzero_capital": cap != 0,
    }
    g1 = own.groupBy("company", "partner", "capital", "profit").agg(F.count(F.lit(1)).alias("c"))
    g1 = g1.select("company", "partner", "c", *[
        (F.when(cond, F.col("c")).otherwise(0)).alias(k) for k, cond in flags.items()])
    g2 = g1.groupBy("company", "partner").agg(
        F.sum("c").alias("pc"), F.count_if(F.col("c") > 1).alias("dup_groups"),
        F.sum(F.col("c") - 1).alias("surplus"), *[F.sum(k).alias(k) for k in flags])
    return g2.agg(
        F.coalesce(F.sum("pc"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in flags],
        F.coalesce(F.sum("dup_groups"), F.lit(0)).alias("duplicated_rows"),
        F.coalesce(F.sum("surplus"), F.lit(0)).alias("surplus_copies"),
        F.count_if(F.col("pc") > 1).alias("repeated_pairs"))


def company_totals(own: DataFrame) -> DataFrame:
    """Per-company sums of capital and profit shares (sorted by capital in the reference)."""
    return own.groupBy("company").agg(F.sum("capital").alias("capital"),
                                      F.sum("profit").alias("profit"))


def own_clean(own: DataFrame) -> DataFrame:
    """Distinct (company, partner, capital, profit) rows with a non-zero capital share."""
    return (own.select("company", "partner", "capital", "profit").dropDuplicates()
            .where(F.col("capital") != 0))


def own_avg_share(own: DataFrame) -> DataFrame:
    """One row per (company, partner) with the mean of both shares."""
    return own.groupBy("company", "partner").agg(F.avg("capital").alias("capital"),
                                                 F.avg("profit").alias("profit"))


def own_weight(avg_share: DataFrame) -> DataFrame:
    """Per company: total capital and total profit of the averaged shares."""
    return avg_share.groupBy("company").agg(F.sum("capital").alias("total_capital"),
                                            F.sum("profit").alias("total_profit"))


def _resolve(mesh_valued: DataFrame) -> DataFrame:
    """Companies whose partners all have a value: capital-weighted mean, in percent of total capital."""
    g = mesh_valued.groupBy("company").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("nv"),
        F.sum(F.col("capital") * F.col("value") * 0.01).alias("s"),
        F.sum("capital").alias("w"))
    return g.where(F.col("n") == F.col("nv")).select(
        "company", (safe_div("s", "w") * 100).alias("value"))


def opacity_level0(avg_share: DataFrame, seed: DataFrame) -> DataFrame:
    """Companies all of whose partners are seeded."""
    return _resolve(_seeded(avg_share, seed))


def _seeded(avg_share: DataFrame, seed: DataFrame) -> DataFrame:
    s = seed.select(F.col("id").alias("partner"), F.col("value"))
    return avg_share.select("company", "partner", "capital").join(s, "partner", "left")


def opacity_propagate(avg_share: DataFrame, seed: DataFrame, max_iter: int | None = None,
                      trace: LoopTrace | None = None) -> tuple[DataFrame, DataFrame]:
    """Iterations until nothing new resolves, or ``0 .. max_iter-1``. Returns (opacity, filled mesh).

    opacity: (company, value, iteration) with the first iteration in which
    the company resolved; filled mesh: (company, partner, capital, value) as
    filled by the last round (NULL where still unknown).

    A company's value is final once it is known, so a round is driven by its frontier, the companies that
    the round before resolved: they send value and weight along the mesh, each receiving company adds them to
    its sums and counts its missing partners down, and those that reach 0 are the next frontier. The other
    companies' sums wait in the message tables of earlier rounds; nothing is refilled.
    """
    trace = trace if trace is not None else LoopTrace()
    seeded = _seeded(avg_share, seed)
    hot = find_hot_keys(seeded, ["partner"])
    mesh = cut_partitioned(salt_big(seeded, ["partner"], hot, ["company"]), *salt_keys(["partner"], hot))
    # per company: partners without a value, and the sums of those with one
    need = cut(mesh.groupBy("company").agg(
        F.count_if(F.col("value").isNull()).alias("missing"), F.sum(F.col("capital") * F.col("value") * 0.01).alias("s"), F.sum("capital").alias("w")))
    share = (safe_div("s", "w") * 100).alias("value")
    frontier = cut(need.where("missing = 0").select("company", share))
    found, messages = [frontier.withColumn("iteration", F.lit(0))], None
    trace.rounds_run = 1
    used = None
    for it in count(1) if max_iter is None else range(1, max_iter):
        used = len(found)
        open_mesh = mesh.where(F.col("value").isNull()).drop("value")
        src = frontier.select(F.col("company").alias("partner"), "value")
        sent = (open_mesh.join(salt_small(src, ["partner"], hot), salt_keys(["partner"], hot))
                .groupBy("company").agg(F.count(F.lit(1)).alias("got"), F.count("value").alias("known"),
                                        F.sum(F.col("capital") * F.col("value") * 0.01).alias("more")))
        sent = cut(sent)
        # only companies that were sent something can resolve: what they were sent before is added up
        before = sent.select("company", F.lit(0).cast("long").alias("got"), F.lit(0).cast("long").alias("known"), F.lit(None).cast("double").alias("more"))
        if messages is not None:
            before = messages.join(sent.select("company"), "company", "left_semi")
        total = sent.unionByName(before).groupBy("company").agg(F.sum("known").alias("known"), F.sum("more").alias("more"))
        ready = need.join(total, "company").where((F.col("known") == F.col("missing")) & (F.col("missing") > 0)) \
            .select("company", (safe_div(F.coalesce("s", F.lit(0.0)) + F.coalesce("more", F.lit(0.0)), F.col("w")) * 100).alias("value"))
        step, obs = observed(ready, grown=F.count(F.lit(1)))
        frontier = cut(step)
        messages = sent if messages is None else messages.unionByName(sent)
        trace.rounds_run += 1
        grown = obs.get["grown"]                      # collected by the round's own write
        trace.changed.append(grown)
        found.append(frontier.withColumn("iteration", F.lit(it)))
        if grown == 0:
            break
    resolved = reduce(DataFrame.unionByName, found)
    filled = mesh.drop(SALT)
    if used is not None:                              # what the last round saw
        seen = reduce(DataFrame.unionByName, found[:used]).select(F.col("company").alias("partner"), F.col("value").alias("_cv"))
        filled = mesh.join(salt_small(seen, ["partner"], hot), salt_keys(["partner"], hot), "left").select(
            "company", "partner", "capital", F.coalesce("value", "_cv").alias("value"))
    return resolved, filled


def opacity_summary(opacity: DataFrame) -> DataFrame:
    """count / mean / std / min / quartiles / max of opacity values, one row."""
    v = F.col("value")
    moments = opacity.agg(F.count(v).alias("count"), F.avg(v).alias("mean"),
                          F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    return moments.join(F.broadcast(opacity_quartiles(opacity))).select(     # one row each
        "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def opacity_quartiles(opacity: DataFrame, probs=(0.25, 0.5, 0.75), key: str = "company",
                      partitions: int | None = None) -> DataFrame:
    """Exact quantiles of the opacity values, linearly interpolated between the
    order statistics at rank (n - 1) * p (as pandas ``describe`` does).

    No task sees all values: they are range-partitioned on (value, company) --
    the key breaks ties, so a value shared by a third of the companies is still
    spread over many partitions -- and sorted within each partition. A row's
    global rank is its position in its partition plus the rows of all lower
    partitions, taken from the per-partition counts (a table of at most
    ``partitions`` rows, the only thing broadcast). Only the rows at the needed
    ranks survive the filter.
    """
    spark = opacity.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = opacity.where(F.col("value").isNotNull()).select(F.col("value").cast("double").alias("v"), key)
    ranked = (v.repartitionByRange(n, "v", key).sortWithinPartitions("v", key)
              .select("v", F.spark_partition_id().alias("pid"),
                      F.monotonically_increasing_id().alias("_mid"))
              .select("v", "pid", (F.col("_mid") - F.shiftleft(F.col("pid").cast("long"), 33)).alias("idx")))
    # used twice below: without a table of its own each use would sample its own range bounds
    ranked = cut(ranked)
    per = ranked.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("pid", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("offset"),
                         F.sum("rows").over(Window.partitionBy()).alias("n"))
    pos = {p: (F.col("n") - 1) * F.lit(p) for p in probs}
    at = ranked.join(F.broadcast(offsets), "pid").select(
        "v", (F.col("offset") + F.col("idx")).alias("rank"), "n")
    wanted = F.lit(False)
    for p in probs:
        wanted = wanted | (F.col("rank") == F.floor(pos[p])) | (F.col("rank") == F.ceil(pos[p]))
    picked = at.where(wanted)
    aggs = []
    for p in probs:
        lo = F.max(F.when(F.col("rank") == F.floor(pos[p]), F.col("v")))
        hi = F.max(F.when(F.col("rank") == F.ceil(pos[p]), F.col("v")))
        frac = F.max(pos[p] - F.floor(pos[p]))
        aggs.append((lo + (hi - lo) * frac).alias(f"q{int(round(p * 100))}"))
    return picked.agg(*aggs)
