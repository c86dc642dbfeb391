"""2.7 Taxpayer 360 and VAT flow inside / between communities.

Plans are single-shuffle where the reference used several aggregates glued by
full outer joins: every arc is expanded into its issuer-side and its
receiver-side row (one pass, no re-scan), and one ``groupBy`` with
side-conditional aggregates produces what the separate aggregates + outer
joins produced. Partial (map-side) aggregation keeps hub taxpayers and big
communities from concentrating raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vatlens.functions.expr import safe_div


def networth(worth: DataFrame, company: str = "company", amount: str = "amount") -> DataFrame:
    """Sum of net worth per company."""
    return worth.groupBy(F.col(company).alias("company")).agg(F.sum(amount).alias("networth"))


def arcs_tagged(arcs: DataFrame, communities: DataFrame, id_col: str = "id",
                community_col: str = "community") -> DataFrame:
    """Arcs with VAT > 0 tagged with the community of both ends; at least one known.

    Rows of ``communities`` with an unknown community cannot change a left join
    result (the tag is NULL either way), so they are filtered before the join.
    """
    known = communities.where(F.col(community_col).isNotNull())
    ci = known.select(F.col(id_col).alias("issuer"), F.col(community_col).alias("issuer_community"))
    cr = known.select(F.col(id_col).alias("receiver"), F.col(community_col).alias("receiver_community"))
    return (arcs.where(F.col("vat") > 0)
            .join(ci, "issuer", "left")
            .join(cr, "receiver", "left")
            .where(F.col("issuer_community").isNotNull() | F.col("receiver_community").isNotNull())
            .select("issuer", "issuer_community", "receiver", "receiver_community", "vat"))


def _sides(tagged: DataFrame) -> DataFrame:
    """One row per (arc, side): side 'i' keyed by the issuer, 'r' by the receiver."""
    ic, rc = F.col("issuer_community"), F.col("receiver_community")
    return tagged.select(
        F.inline(F.array(
            F.struct(F.lit("i").alias("side"), F.col("issuer").alias("taxpayer"),
                     ic.alias("own"), rc.alias("other"), F.col("vat").alias("vat")),
            F.struct(F.lit("r").alias("side"), F.col("receiver").alias("taxpayer"),
                     rc.alias("own"), ic.alias("other"), F.col("vat").alias("vat")))))


def _side_aggs(side: str, suffix: str, null_counts_when_absent: bool):
    s = F.col("side") == side
    same = s & (F.col("own") == F.col("other"))
    extra = s & (F.col("own") != F.col("other")) & F.col("other").isNotNull()
    n_same = F.count(F.when(same, 1))
    n_extra = F.count(F.when(extra, 1))
    if null_counts_when_absent:
        present = F.max(s.cast("int")) == 1
        n_same = F.when(present, n_same)
        n_extra = F.when(present, n_extra)
    return [
        F.sum(F.when(same, F.col("vat")).otherwise(0)).alias(f"vat_intra_{suffix}"),
        F.sum(F.when(extra, F.col("vat")).otherwise(0)).alias(f"vat_extra_{suffix}"),
        n_same.alias(f"arcs_intra_{suffix}"),
        n_extra.alias(f"arcs_extra_{suffix}"),
    ]


def flow_issuer(tagged: DataFrame) -> DataFrame:
    """Per issuer: VAT and arc count to its own community and to other known ones."""
    rows = _sides(tagged).where(F.col("side") == "i")
    return (rows.groupBy(F.col("taxpayer").alias("issuer"))
            .agg(*_side_aggs("i", "issued", False)))


def flow_receiver(tagged: DataFrame) -> DataFrame:
    rows = _sides(tagged).where(F.col("side") == "r")
    return (rows.groupBy(F.col("taxpayer").alias("receiver"))
            .agg(*_side_aggs("r", "received", False)))


def taxpayer_flow(tagged: DataFrame) -> DataFrame:
    """Full outer combination of issuer and receiver flows in one aggregation:
    money is 0 for an absent side, arc counts stay NULL."""
    return (_sides(tagged).groupBy("taxpayer")
            .agg(*_side_aggs("i", "issued", True), *_side_aggs("r", "received", True)))


def community_flow(tagged: DataFrame) -> DataFrame:
    """Per community: issued / received x intra / extra sums and arc counts.

    A measure is NULL when the community has no arc of that kind (the meaning
    of the reference's chain of full outer joins)."""
    both = tagged.where(F.col("issuer_community").isNotNull()
                        & F.col("receiver_community").isNotNull())
    rows = _sides(both)
    same = F.col("own") == F.col("other")
    aggs = []
    for side, name in (("i", "issued"), ("r", "received")):
        s = F.col("side") == side
        aggs += [
            F.sum(F.when(s & same, F.col("vat"))).alias(f"{name}_intra"),
            F.sum(F.when(s & ~same, F.col("vat"))).alias(f"{name}_extra"),
            F.nullif(F.count(F.when(s & same, 1)), F.lit(0)).alias(f"arcs_{name}_intra"),
            F.nullif(F.count(F.when(s & ~same, 1)), F.lit(0)).alias(f"arcs_{name}_extra"),
        ]
    return rows.groupBy(F.col("own").alias("com")).agg(*aggs)


def community_ratios(cflow: DataFrame) -> DataFrame:
    """% extra issued, % extra received, extra/intra issued rate; NULL when a side is missing."""
    return cflow.select(
        "com",
        (safe_div("issued_extra", F.col("issued_intra") + F.col("issued_extra")) * 100)
        .alias("pct_issued_extra"),
        (safe_div("received_extra", F.col("received_intra") + F.col("received_extra")) * 100)
        .alias("pct_received_extra"),
        "issued_extra", "received_extra", "issued_intra", "received_intra",
        safe_div("issued_extra", "issued_intra").alias("rate_issued_extra_intra"),
        "arcs_issued_intra", "arcs_issued_extra", "arcs_received_intra", "arcs_received_extra",
    )


def community_size(ratios: DataFrame, members: DataFrame, group_col: str = "community") -> DataFrame:
    """Members per community (the NULL group included) joined onto the community table."""
    size = members.groupBy(F.col(group_col).alias("com")).agg(F.count(F.lit(1)).alias("community_size"))
    return ratios.join(size, "com", "left")


def latest_carried(t360: DataFrame, carried: DataFrame, id_col: str = "id") -> DataFrame:
    """Newest carried-credit period per receiver (``rank``: ties are all kept) joined to 360."""
    w = Window.partitionBy("receiver").orderBy(F.col("period").desc())
    last = (carried.select("period", "receiver", "carried_cont")
            .withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1)
            .select(F.col("period").alias("last_carried_period"), "receiver", "carried_cont"))
    return (t360.join(last, t360[id_col] == last.receiver, "left").drop("receiver"))


def extreme_regions(invoices_by_point: DataFrame, point_region: DataFrame,
                    north: tuple[str, ...], south: tuple[str, ...]) -> DataFrame:
    """Issuer -> point of sale -> region; flags sales to the far north / far south.

    ``invoices_by_point``: (issuer, point); ``point_region``: (point, region).
    ``north`` and ``south`` are whole region names."""
    pts = (invoices_by_point.where(F.col("issuer").isNotNull())
           .groupBy("issuer", "point").agg(F.count(F.lit(1)).alias("n")))
    pr = pts.join(point_region, "point", "inner").where(F.col("region").isNotNull())
    flagged = pr.select("issuer",
                        F.when(F.col("region").isin(*north), 1).otherwise(0).alias("north"),
                        F.when(F.col("region").isin(*south), 1).otherwise(0).alias("south"))
    g = flagged.groupBy("issuer").agg(F.sum("north").alias("total_north"),
                                      F.sum("south").alias("total_south"))
    return g.withColumn("sells_extremes",
                        F.when((F.col("total_north") > 0) & (F.col("total_south") > 0), "si")
                        .otherwise("no"))


T360_COLUMNS = (
    "id", "is_company", "is_accountant", "is_natural", "is_rep", "contamination", "paid_total", "vat_net",
    "region", "n_documents", "lifetime_days", "initial_alert", "opacity", "kin_owners", "natural_partners",
    "kinship_rate", "initial_group", "community", "fee_workers", "dependent_workers", "networth",
)


def taxpayer_360(communities: DataFrame, labels: DataFrame, opacity: DataFrame, kinship: DataFrame,
                 workers: DataFrame, worth: DataFrame) -> DataFrame:
    """Community members left-joined with labels, opacity, kinship, workers and net worth
    (one row per member; every right side is unique per taxpayer, so nothing fans out)."""
    lab = labels.select("id", F.col("score").alias("contamination"), "paid_total", "vat_net", "region",
                        "n_documents", F.col("lifetime").alias("lifetime_days"), "initial_alert")
    op = opacity.select(F.col("company").alias("id"), F.col("value").alias("opacity"))
    kin = kinship.select(F.col("company").alias("id"), "kin_owners", F.col("total").alias("natural_partners"),
                         "kinship_rate")
    wk = workers.select("id", "fee_workers", "dependent_workers")
    nw = worth.select(F.col("company").alias("id"), "networth")
    out = (communities.join(lab, "id", "left").join(op, "id", "left").join(kin, "id", "left")
           .join(wk, "id", "left").join(nw, "id", "left"))
    return out.select(*T360_COLUMNS)
