"""2.6 Period-by-period VAT credit tracing.

For one tax period: build issuer -> receiver edges from the purchase ledger,
mark contaminated issuers by origin, push the contaminated net VAT through
five hops capped by each receiver's declaration, summarise per origin, pivot
the seven origins into one row per receiver, and total the hops.

Origins: 1 issuer does not declare, 2 alert, 3 special credit, 4 observation
W08, 5 carried credit, 6 observation FM01, 7 unauthorised document type 30.

Physical plan notes (the point of the rewrite, see README):
* the edge table of hops 2..5 is salted on hot issuers (``plans.skew``),
  hash-partitioned on (issuer, period, salt) and checkpointed once; each hop
  joins it on that key, so a hop shuffles only the previous hop's (small)
  result, and an issuer holding a third of the edges is spread over all tasks;
* the declaration table used by every hop is partitioned on (id, period)
  once, so each hop's aggregate meets it without re-shuffling it;
* the seven per-origin left joins with OR conditions are one pivot
  (a single aggregation), and the five per-hop left joins of the summary are
  conditional aggregates in the same pass;
* ledger documents are aggregated to edges before the declaration flags are
  joined on (flags depend on the edge ends only), so the ~40M documents of a
  period cross no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vatlens.functions.expr import clamp_min, least_of, nz, prior_period_int, safe_div
from vatlens.plans.iterate import bucketed, cut_partitioned, kept, release, scratch_path, shuffles_removed, together
from vatlens.plans.skew import SALT, find_hot_keys, salt_big, salt_keys, salt_small

# fixed values of the reference ------------------------------------------
VALIDITY_OK = (1, 3)
TX_TYPES = (1, 2, 3, 4, 5, 6)
LEDGER_DOC_TYPES = (30, 33, 55, 56, 60, 61)
INVOICE_DOC_TYPES = (29, 30, 33, 45, 46, 55, 56)
CREDIT_NOTE_DOC_TYPES = (60, 61)
PURCHASE = "COMPRA"
ALERT_CODES = ("4110", "4111", "4112")
UNAUTHORISED_DOC_TYPE = 30
AUTH_ATTRIBUTE = "POFE"
OBS_FM01, OBS_W08 = "FM01", "W08"
OBS_ACTIVE_STATUS = "V"
ORIGIN_SUFFIX = {1: "nd", 2: "al", 3: "ce", 4: "w08", 5: "rem", 6: "fm01", 7: "ed30"}
TOTAL_ORIGINS = ("al", "rem", "nd", "w08", "fm01", "ed30")   # hop totals leave special credit out
PIVOT_ORDER = ("al", "nd", "ce", "w08", "rem", "fm01", "ed30")
CARRIED_ORDER = ("rem", "nd", "al", "w08", "ed30", "ce", "fm01")
PHANTOM = {"CE": "PHANTOM CE", "W08": "PHANTOM W08", "REM": "PHANTOM REM", "FM01": "PHANTOM FM01"}
NORMAL = "NORMAL"
# hop k >= 2: (NC multiplies invoice proportion, product rounding, sums rounded,
#              requires iva_fact_cdo > 0 on the previous hop)
HOP_RULES = {
    2: (True, 1, None, False),
    3: (False, 1, 1, True),
    4: (False, 5, 1, True),
    5: (False, 5, 1, True),
}


def _c(name: str) -> Column:
    return F.col(name)


# ------------------------------------------------------------ periods
def periods(spark, today: str, n_years: int) -> DataFrame:
    """Months (YYYYMM) of the last ``n_years`` years before ``today``'s month, which is excluded."""
    start = F.trunc(F.to_date(F.lit(today)), "MM")
    end = F.trunc(F.date_sub(start, 365 * n_years), "MM")
    months = F.sequence(F.add_months(end, 1), F.add_months(start, -1), F.expr("interval 1 month"))
    return (spark.range(1).select(F.explode(months).alias("m"))
            .select(F.date_format("m", "yyyyMM").cast("int").alias("period")))


# ------------------------------------------------------------ declarations
def _of(df: DataFrame, period: int | None) -> DataFrame:
    """Rows of one period; of all periods without one. What follows is keyed by period either way."""
    return df if period is None else df.where(_c("period") == period)


def decl_latest(decl: DataFrame, period: int | None) -> DataFrame:
    """Highest folio per (taxpayer, period) among valid declarations with code 537 > 0."""
    d = _of(decl, period).where(_c("validity").isin(*VALIDITY_OK) & (_c("c_537") > 0))
    return d.groupBy("id", "period").agg(F.max("folio").alias("max_folio"))


def _latest_rows(decl: DataFrame, period: int | None) -> DataFrame:
    d = _of(decl, period).where(_c("validity").isin(*VALIDITY_OK) & (_c("c_537") > 0))
    newest = d.groupBy(F.col("id").alias("_id"), F.col("period").alias("_period")).agg(F.max_by(F.struct(*d.columns), "folio").alias("_r"))
    return newest.select("_r.*")


SPECIAL_CODES = ("c_725", "c_704", "c_160", "c_126", "c_572", "c_768", "c_767")


def _sum_nz(*cols: str) -> Column:
    out = nz(cols[0])
    for c in cols[1:]:
        out = out + nz(c)
    return out


def decl_prior(decl: DataFrame, prior: int | None) -> DataFrame:
    """Previous-period declaration: 537, 538, 77, special credit and carry ratio."""
    d = _latest_rows(decl, prior)
    den = F.col("c_537") + _sum_nz(*SPECIAL_CODES)
    return d.select(
        "id", F.col("period").alias("period_ant"), F.col("c_537").alias("f29_537_ant"),
        nz("c_538").alias("f29_538_ant"), nz("c_77").alias("f29_77_ant"),
        (nz("c_768") + nz("c_767")).alias("special_cr_ant"),
        F.round(safe_div(nz("c_77"), den), 6).alias("carry_ratio_ant"))


def decl_current(decl: DataFrame, period: int | None) -> DataFrame:
    """Current-period declaration with invoice / credit-note credit, net credit and special credit."""
    d = _latest_rows(decl, period)
    fact_cr = _sum_nz("c_520", "c_762", "c_766", "c_525")
    net = fact_cr + nz("c_504") - nz("c_528") + _sum_nz("c_532", "c_535", "c_553")
    return d.select(
        "id", F.col("c_502").alias("fact_amt"), F.col("c_503").alias("fact_qty"), "c_519", "c_520",
        "period", F.col("c_762").alias("fact_cr_sup"), F.col("c_766").alias("fact_cr_const"),
        F.col("c_525").alias("fact_cr_fixed"), nz("c_528").alias("nc_cr"), fact_cr.alias("fact_cr"),
        "c_538", F.col("c_509").alias("nc_qty"), F.col("c_510").alias("nc_amt"), "c_537",
        net.alias("net_cr"), _sum_nz(*SPECIAL_CODES).alias("special_cr"), nz("c_504").alias("c_504"),
    )


def observations(obs: DataFrame, code: str, period: int | None) -> DataFrame:
    """Active observations (no end date, status V) of one code in a period."""
    return _of(obs, period).where((_c("code") == code) & _c("end_date").isNull()
                                  & (_c("status") == OBS_ACTIVE_STATUS)).select("id", "period", "amount")


def decl_adjust_fm01(current: DataFrame, fm01: DataFrame) -> DataFrame:
    """Carried credit (504) reduced by the FM01 amount, floor 0; FM01 capped by 504."""
    o = fm01.select("id", "period", F.col("amount").alias("_fm"))
    j = current.join(o, ["id", "period"], "left")
    diff = nz("c_504") - nz("_fm")
    return j.select(
        *[c for c in current.columns if c != "c_504"],
        F.col("c_504").alias("c_504_orig"),
        F.when(diff < 0, F.lit(0)).otherwise(diff).alias("c_504"),
        F.when(diff < 0, nz("c_504")).otherwise(nz("_fm")).alias("fm01"))


def carry_in(decl1: DataFrame, prior: DataFrame, period: int, prior_period: int,
             history: DataFrame | None) -> DataFrame:
    """Carried contaminated credit entering the period.

    With history: the prior period's total contaminated proportion (floored at
    0) times the adjusted 504 of this period, round 4. Cold start: 0."""
    inputs = carry_inputs(decl1, prior.select("id", F.lit(period).alias("period"), "f29_77_ant"))
    return carry_of(inputs, period, prior_period, history)


def carry_inputs(decl1: DataFrame, prior: DataFrame) -> DataFrame:
    """(receiver, period, f29_77_ant, c_504_orig, c_504, fm01, declares) of all who declared in a period or
    the one before it; ``prior`` has the period it is prior to."""
    p = prior.select(F.col("id").alias("receiver"), "period", "f29_77_ant")
    d = decl1.select(F.col("id").alias("receiver"), "period", "c_504_orig", "c_504", "fm01", F.lit(1).alias("declares"))
    return d.join(p, ["receiver", "period"], "full").select(
        "receiver", "period", "f29_77_ant", "c_504_orig", "c_504", "fm01", nz("declares").alias("declares"))


def carry_of(inputs: DataFrame, period: int, prior_period: int, history: DataFrame | None) -> DataFrame:
    """``carry_in`` from the period's ``carry_inputs``."""
    if history is None:
        return inputs.where(_c("declares") == 1).select(
            F.lit(prior_period).alias("period_ant"), "receiver", F.lit(period).alias("period"),
            F.lit(0).cast("double").alias("total_cont_an_ant"),
            F.lit(0).cast("double").alias("prop_total_cont_an_ant"), "f29_77_ant", "c_504_orig",
            "c_504", "fm01", F.lit(0).cast("double").alias("carried_cont"))
    h = history.where(_c("period") == prior_period).select(
        "receiver", "total_cont_an", clamp_min(nz("prop_total_cont_an")).alias("_prop"))
    j = h.join(inputs.drop("period"), "receiver", "left")
    return j.select(
        F.lit(prior_period).alias("period_ant"), "receiver", F.lit(period).alias("period"),
        F.col("total_cont_an").cast("double").alias("total_cont_an_ant"),
        F.col("_prop").cast("double").alias("prop_total_cont_an_ant"), "f29_77_ant", "c_504_orig",
        "c_504", "fm01",
        # money: the product is exact in DECIMAL, so the 4-digit rounding cannot fall on a float tie
        F.round(F.col("_prop").cast("decimal(20,10)") * nz("c_504"), 4).cast("double")
        .alias("carried_cont"))


# ------------------------------------------------------------ ledger -> edges
def ledger_docs(ledger: DataFrame, period: int | None) -> DataFrame:
    """Purchases of the period split into invoice and credit-note VAT (signed)."""
    lg = _of(ledger, period).where(_c("tx_type").isin(*TX_TYPES)
                                   & _c("doc_type").isin(*LEDGER_DOC_TYPES) & (_c("operation") == PURCHASE))
    inv = _c("doc_type").isin(*INVOICE_DOC_TYPES)
    nc = _c("doc_type").isin(*CREDIT_NOTE_DOC_TYPES)
    zero = F.lit(0).cast(lg.schema["vat"].dataType)
    return lg.select(
        "doc_id", "period", "issuer", "receiver", "doc_type",
        F.when(inv, _c("vat")).otherwise(zero).alias("iva_fact"),
        F.when(nc, _c("vat")).otherwise(zero).alias("iva_nc"),
        inv.cast("int").alias("is_fact"), nc.cast("int").alias("is_nc"),
        F.when(nc, -_c("vat")).otherwise(_c("vat")).alias("signed_vat"))


def trade_sums(docs: DataFrame) -> DataFrame:
    """Per (issuer, receiver, period): sums and counts and net VAT."""
    return docs.groupBy("issuer", "receiver", "period").agg(
        F.sum("iva_fact").alias("iva_fact"), F.sum("iva_nc").alias("iva_nc"),
        F.count(F.lit(1)).alias("qty_docto"), F.sum("is_fact").alias("qty_fact"),
        F.sum("is_nc").alias("qty_nc"),
        (F.sum(nz("iva_fact")) - F.sum(nz("iva_nc"))).alias("iva_neto1"),
        F.sum(nz("signed_vat")).alias("iva_neto_cv1"))


def trade_edges(docs: DataFrame, decl1: DataFrame, summed: bool = False) -> DataFrame:
    """``trade_sums`` and whether each end declared. ``summed``: ``docs`` are those sums, as a table of their own.

    The declarations are a table of their own too: both sides of each join are then plain shuffles, and AQE
    splits an issuer or receiver that holds much of the edges."""
    e = docs if summed else trade_sums(docs)
    dk = decl1.select("id", "period")           # one declaration per (id, period)
    ie = dk.select(F.col("id").alias("issuer"), "period", F.lit(1).alias("issuer_declares"))
    re = dk.select(F.col("id").alias("receiver"), "period", F.lit(1).alias("receiver_declares"))
    j = e.join(ie, ["issuer", "period"], "left").join(re, ["receiver", "period"], "left")
    return j.select("issuer", "receiver", "period", "iva_fact", "iva_nc", "qty_docto", "qty_fact",
                    "qty_nc", "iva_neto1", "iva_neto_cv1",
                    nz("issuer_declares").alias("issuer_declares"),
                    nz("receiver_declares").alias("receiver_declares"))


def trade_edges_clamped(edges: DataFrame) -> DataFrame:
    """Negative nets become 0."""
    return edges.select("issuer", "receiver", "period", "iva_fact", "iva_nc", "qty_docto", "qty_fact",
                        "qty_nc", clamp_min("iva_neto1").alias("iva_neto"),
                        clamp_min("iva_neto_cv1").alias("iva_neto_cv"),
                        "issuer_declares", "receiver_declares")


DECLARED_COLS = ("id", "period", "fact_amt", "fact_qty", "c_519", "c_520", "fact_cr_sup",
                 "fact_cr_const", "fact_cr_fixed", "nc_cr", "fact_cr", "c_538", "nc_qty", "nc_amt",
                 "c_537", "net_cr", "special_cr", "c_504")


def decl_or_ledger(decl1: DataFrame, edges: DataFrame) -> DataFrame:
    """Declarations (kind 'f29') plus receivers that only appear in the ledger (kind 'rcv').

    Ledger-only rows take their credit from the purchases; columns are
    aligned by name (the reference's positional union misplaced them). Net
    credit is floored at 0."""
    f29 = decl1.select(*DECLARED_COLS, F.lit("f29").alias("kind"))
    only = edges.join(decl1.select(F.col("id").alias("receiver"), "period"),
                      ["receiver", "period"], "left_anti")
    zero = F.lit(0)
    rcv = only.groupBy(F.col("receiver").alias("id"), "period").agg(
        F.sum("iva_nc").alias("nc_cr"), F.sum("iva_fact").alias("fact_cr"),
        F.sum("iva_neto").alias("c_537"), F.sum("iva_neto").alias("net_cr"))
    rcv = rcv.select(
        "id", "period", zero.alias("fact_amt"), zero.alias("fact_qty"), zero.alias("c_519"),
        zero.alias("c_520"), zero.alias("fact_cr_sup"), zero.alias("fact_cr_const"),
        zero.alias("fact_cr_fixed"), "nc_cr", "fact_cr", zero.alias("c_538"), zero.alias("nc_qty"),
        zero.alias("nc_amt"), "c_537", "net_cr", zero.alias("special_cr"), zero.alias("c_504"),
        F.lit("rcv").alias("kind"))
    u = f29.unionByName(rcv, allowMissingColumns=False).distinct()
    return u.withColumn("net_cr", clamp_min("net_cr"))


# ------------------------------------------------------------ seeds
def nondeclaring_issuers(edges: DataFrame, declared: DataFrame) -> DataFrame:
    """Edges whose issuer has no 'f29' declaration in the period, summed per (issuer, period, receiver)."""
    f = declared.where(_c("kind") == "f29").select(F.col("id").alias("issuer"), "period")
    return (edges.join(f, ["issuer", "period"], "left_anti")
            .groupBy("issuer", "period", "receiver")
            .agg(F.sum("iva_fact").alias("iva_fact"), F.sum("iva_nc").alias("iva_nc"),
                 F.sum("qty_docto").alias("qty_docto"), F.sum("iva_neto").alias("iva_neto")))


def doc30_issuers(ledger: DataFrame, auth: DataFrame, period: int | None) -> DataFrame:
    """Issuers of type-30 purchases in the period without an open POFE authorisation."""
    d = _of(ledger, period).where((_c("doc_type") == UNAUTHORISED_DOC_TYPE)
                                  & (_c("operation") == PURCHASE)).select("issuer", "period").distinct()
    ok = auth.where((_c("attribute") == AUTH_ATTRIBUTE) & _c("end_date").isNull()).select(
        F.col("id").alias("issuer"))
    return d.join(ok, "issuer", "left_anti")


def alerted_issuers(edges: DataFrame, alerts: DataFrame) -> DataFrame:
    """(issuer, period) of issuers with an active alert 4110-4112 (not deactivated by a user, not unblocked)."""
    a = alerts.where(_c("deactivated_by").isNull() & _c("unblock_folio").isNull()
                     & _c("code").isin(*ALERT_CODES)).select(F.col("id").alias("issuer"))
    return edges.select("issuer", "period").distinct().join(a, "issuer", "left_semi")


def special_credit(declared: DataFrame, period: int | None) -> DataFrame:
    """Taxpayers with special credit > 0 in the period."""
    return _of(declared, period).where(_c("special_cr") > 0).select("id", "special_cr", "period")


def _self_edge(df: DataFrame, id_col: str, amount: Column, kind: str) -> DataFrame:
    return df.select(
        F.col(id_col).alias("issuer"), F.col(id_col).alias("receiver"), "period",
        F.lit(0).alias("iva_fact"), F.lit(0).alias("iva_nc"), F.lit(0).alias("qty_docto"),
        F.lit(0).alias("qty_fact"), F.lit(0).alias("qty_nc"), amount.alias("iva_neto"),
        F.lit(0).alias("iva_neto_cv"), F.lit(1).alias("issuer_declares"),
        F.lit(1).alias("receiver_declares"), F.lit(kind).alias("node_kind"))


def self_edges(special: DataFrame, w08: DataFrame, fm01: DataFrame) -> DataFrame:
    """Self edges that carry special credit, W08 and FM01: those that need no earlier period."""
    ce = _self_edge(special.groupBy("id", "period").agg(F.sum("special_cr").alias("a")), "id", F.col("a"), PHANTOM["CE"])
    w = _self_edge(w08.groupBy("id", "period").agg(F.sum("amount").alias("a")), "id", F.col("a"), PHANTOM["W08"])
    fm = _self_edge(fm01.groupBy("id", "period").agg(F.sum("amount").alias("a")), "id", F.col("a"), PHANTOM["FM01"])
    return ce.unionByName(w).unionByName(fm)


def carried_edges(carry: DataFrame) -> DataFrame:
    """Self edges that carry the credit of the period before."""
    return _self_edge(carry, "receiver", F.col("carried_cont"), PHANTOM["REM"])


def phantom_edges(edges: DataFrame, special: DataFrame, w08: DataFrame, carry: DataFrame,
                  fm01: DataFrame) -> DataFrame:
    """Normal edges plus self edges carrying special credit, W08, carried credit and FM01."""
    normal = edges.withColumn("node_kind", F.lit(NORMAL))
    # normal edges are unique by their keys; only self edges can repeat
    return normal.unionByName(self_edges(special, w08, fm01).unionByName(carried_edges(carry)).distinct())


def edge_level0(pedges: DataFrame) -> DataFrame:
    """Projection of the edges (unique rows) at level 0."""
    return pedges.select("issuer", "receiver", "iva_fact", "iva_nc", "period", F.lit(0).alias("level"),
                         "qty_docto", "iva_neto", "node_kind", "issuer_declares",
                         "receiver_declares")


# ------------------------------------------------------------ hops
def _credit_test() -> Column:
    return ((_c("c_520") > 0) | (_c("fact_cr_sup") > 0) | (_c("fact_cr_const") > 0)
            | (_c("fact_cr_fixed") > 0) | (_c("nc_cr") > 0))


def seed_table(doc30: DataFrame, nondecl: DataFrame, alerted: DataFrame) -> DataFrame:
    """(issuer, period, origin) for the issuer-based origins 7, 1 and 2."""
    return (doc30.select("issuer", "period", F.lit(7).alias("origin"))
            .unionByName(nondecl.select("issuer", "period", F.lit(1).alias("origin")))
            .unionByName(alerted.select("issuer", "period", F.lit(2).alias("origin")))
            .distinct())


def hop1_by_origin(level0: DataFrame, declared: DataFrame, seeds: DataFrame,
                   phantom_origins: bool = True) -> DataFrame:
    """Hop-1 contaminated amounts per edge and origin (capped by the receiver's declaration)."""
    d = declared.withColumnRenamed("id", "receiver")
    e = level0.join(d, ["receiver", "period"], "inner")
    f29 = _c("kind") == "f29"
    seeded = (e.join(seeds, ["issuer", "period"], "inner")
              .where((f29 & _credit_test() & _c("origin").isin(1, 2, 7))
                     | ((_c("kind") == "rcv") & (_c("origin") == 2)))
              .withColumn("out_kind", _c("kind")))
    nk = _c("node_kind")
    ph = (e.where(nk != NORMAL)
          .withColumn("origin", F.when(f29 & (nk == PHANTOM["CE"]), 3)
                      .when((_c("kind") == "rcv") & (nk == PHANTOM["CE"]), 4))
          .withColumn("out_kind", F.when(_c("origin") == 3, "f29 CE").otherwise("RCV CE")))
    parts = [seeded, ph.where(_c("origin").isNotNull())]
    if phantom_origins:
        extra = (e.where(f29 & nk.isin(PHANTOM["W08"], PHANTOM["REM"], PHANTOM["FM01"]))
                 .withColumn("origin", F.when(nk == PHANTOM["W08"], 4)
                             .when(nk == PHANTOM["REM"], 5).otherwise(6))
                 .withColumn("out_kind", F.concat(F.lit("f29 "), F.regexp_replace(nk, "PHANTOM ", ""))))
        parts.append(extra)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    fact_c = least_of("iva_fact", "fact_cr")
    nc_c = least_of("iva_nc", "nc_cr")
    cap = F.when(_c("origin").isin(3, 4, 5, 6), _c("net_cr") + _c("special_cr")).otherwise(_c("net_cr"))
    within = (_c("iva_neto") >= 0) & (_c("iva_neto") <= cap)
    neither = (_c("issuer_declares") == 0) & (_c("receiver_declares") == 0)
    neto_c = (F.when(_c("origin").isin(1, 7) & neither, F.lit(0))
              .when(within, _c("iva_neto")).otherwise(cap))
    return rows.select(
        "issuer", "receiver", "period", fact_c.alias("iva_fact_cont"), nc_c.alias("iva_nc_cont"),
        "iva_fact", "iva_nc", "nc_cr", "iva_neto", "qty_docto", "fact_cr", "net_cr",
        (fact_c - nc_c).alias("neto_ctdo"), neto_c.alias("iva_neto_cont"), "origin",
        F.col("out_kind").alias("kind"), "issuer_declares", "receiver_declares").distinct()


RESULT_COLS = ("period", "receiver", "f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "iva_fact_cdo",
               "iva_nc_cdo", "iva_neto_cdo", "prop_fact_cdo", "prop_nc_cdo", "prop_neto_cdo", "hop",
               "c_537", "origin")


def _declared_caps(declared: DataFrame) -> DataFrame:
    """The receiver's declared caps, keyed (receiver, period): one row per declarant."""
    return declared.select(F.col("id").alias("receiver"), "period", _c("fact_cr").alias("mf"),
                           _c("nc_cr").alias("mn"), _c("net_cr").alias("mnet"),
                           _c("special_cr").alias("ms"), "c_537")


def hop1_result(hop1: DataFrame, declared: DataFrame) -> DataFrame:
    """Per (period, receiver, origin): capped sums, remainders and proportions (round 5).

    Edge rows are summed per (period, receiver, origin) first (partial
    aggregation on the map side, so a receiver with a huge number of issuers
    is combined before the shuffle); only then are the sums joined to the
    receiver's declaration (one row per declarant)."""
    return hop1_capped(hop1_sums(hop1), declared)


def hop1_sums(hop1: DataFrame) -> DataFrame:
    """Edge rows of hop 1 summed per (period, receiver, origin)."""
    return hop1.groupBy("period", "receiver", "origin").agg(
        F.sum("iva_fact_cont").alias("s_fact"), F.sum("iva_nc_cont").alias("s_nc"),
        F.sum("iva_neto_cont").alias("s_net"), F.sum("issuer_declares").alias("s_ie"),
        F.sum("receiver_declares").alias("s_re"))


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``; without "period" among them both sides are of one period, which ``left`` keeps."""
    return left.join(right if "period" in keys else right.drop("period"), keys, "inner")


def hop1_capped(sums: DataFrame, declared: DataFrame, by_period: bool = True) -> DataFrame:
    """Sums of hop 1 capped by the receiver's declaration (see ``hop1_result``)."""
    g = _meet(sums, _declared_caps(declared), ["receiver"] + ["period"] * by_period)
    fact_cdo = least_of("s_fact", "mf")
    nc_cdo = least_of("s_nc", "mn")
    neto_cdo = (F.when(_c("origin") == 3, _c("s_net"))
                .when((_c("s_ie") == 0) & (_c("s_re") == 0), F.lit(0))
                .when(_c("s_net") <= _c("mnet"), _c("s_net")).otherwise(_c("mnet")))
    prep = g.select("period", "receiver", "origin", fact_cdo.alias("fcdo"), nc_cdo.alias("ncdo"),
                    neto_cdo.alias("netcdo"), "c_537",
                    _c("mf").alias("fact_reci"), _c("mn").alias("nc_reci"),
                    (_c("mnet") + _c("ms")).alias("neto_reci"))
    return prep.select(
        "period", "receiver", _c("fact_reci").alias("f29_fact_reci"), _c("nc_reci").alias("f29_nc_reci"),
        _c("neto_reci").alias("f29_neto_reci"), least_of("fcdo", "fact_reci").alias("iva_fact_cdo"),
        least_of("ncdo", "nc_reci").alias("iva_nc_cdo"),
        F.when(_c("origin") == 3, _c("netcdo")).when(_c("netcdo") <= _c("neto_reci"), _c("netcdo"))
        .otherwise(_c("neto_reci")).alias("iva_neto_cdo"),
        F.round(safe_div(nz("fcdo"), nz("fact_reci")), 5).alias("prop_fact_cdo"),
        F.round(safe_div(nz("ncdo"), nz("nc_reci")), 5).alias("prop_nc_cdo"),
        F.round(safe_div(nz("netcdo"), nz("neto_reci")), 5).alias("prop_neto_cdo"),
        F.lit(1).alias("hop"), "c_537", "origin")


def hop_edges(pedges: DataFrame, materialise=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Edges used by hops 2..5 (self edges excluded), salted on hot issuers;
    returns (edges, hot issuers). ``trace_period`` hash-partitions them on
    (issuer, period, _salt) once for all four hops."""
    e = pedges.where(_c("issuer") != _c("receiver")).select(
        "issuer", "receiver", "period", "iva_fact", "iva_nc", "iva_neto")
    hot = find_hot_keys(e, ["issuer", "period"], materialise=materialise)
    return salt_big(e, ["issuer", "period"], hot, ["receiver"]), hot


def hop_next(pedges: DataFrame, prev: DataFrame, declared: DataFrame, hop: int,
             hot: DataFrame | None = None, by_period: bool = True) -> DataFrame:
    """Hop ``hop`` (2..5): each edge of an already contaminated issuer carries its VAT times
    the issuer's contaminated proportion; self edges are excluded; sums are capped by the
    receiver's declaration. When the edges are salted (``hop_edges``; ``hot`` is None when
    no issuer is hot) the previous hop's rows of hot issuers are repeated per salt bucket.
    Without ``by_period`` all inputs are of one period and meet on the taxpayer alone."""
    nc_uses_fact, prod_digits, sum_digits, need_fact = HOP_RULES[hop]
    p = prev.select(F.col("receiver").alias("issuer"), "period", "origin",
                    _c("iva_fact_cdo").alias("p_fact_cdo"), "prop_fact_cdo", "prop_nc_cdo",
                    "prop_neto_cdo")
    if need_fact:
        p = p.where(_c("p_fact_cdo") > 0)
    e = pedges.where(_c("issuer") != _c("receiver"))
    keys = ["issuer"] + ["period"] * by_period
    if SALT in e.columns:                             # salted on hot issuers (``hop_edges``)
        j = _meet(e, salt_small(p, ["issuer", "period"], hot), [*keys, SALT])
    else:
        j = _meet(e.select("issuer", "receiver", "period", "iva_fact", "iva_nc", "iva_neto"), p, keys)

    def carried(amount: str, prop: str) -> Column:
        """Money times a proportion of 5 digits, exact in DECIMAL: no rounding (here or of the sums)
        depends on the order of summation or falls on a float tie."""
        exact = _c(amount).cast("decimal(20,4)") * _c(prop).cast("decimal(10,5)")
        return F.round(exact, prod_digits).cast("decimal(28,5)")

    rows = j.select(
        "period", "receiver", "origin", carried("iva_fact", "prop_fact_cdo").alias("pf"),
        carried("iva_nc", "prop_fact_cdo" if nc_uses_fact else "prop_nc_cdo").alias("pn"),
        carried("iva_neto", "prop_neto_cdo").alias("pt"))
    # sum per (period, receiver, origin) before meeting the declarations (map-side combine)
    sums = rows.groupBy("period", "receiver", "origin").agg(
        F.sum("pf").alias("sf"), F.sum("pn").alias("sn"), F.sum("pt").alias("st"))
    # caps as DOUBLE, once per declaration
    caps = _declared_caps(declared).select("receiver", "period", *[_c(c).cast("double").alias(c) for c in ("mf", "mn", "mnet", "c_537")],
                                           (_c("mnet") + _c("ms")).cast("double").alias("mneto"))
    g = _meet(sums, caps, ["receiver"] + ["period"] * by_period)

    def capped(s: str, m: str) -> Column:
        v = F.round(_c(s), sum_digits) if sum_digits is not None else _c(s)
        # as DOUBLE: a common DECIMAL type of both could lose the sum's last digits
        return F.when(v.cast("double") <= _c(m), v.cast("double")).otherwise(_c(m))

    def prop(s: str, m: str) -> Column:
        return F.when(_c(s).cast("double") <= _c(m), F.round(safe_div(s, m), 5)).otherwise(F.lit(1.0))

    return g.select(
        "period", "receiver", _c("mf").alias("f29_fact_reci"), _c("mn").alias("f29_nc_reci"),
        _c("mneto").alias("f29_neto_reci"), capped("sf", "mf").alias("iva_fact_cdo"),
        capped("sn", "mn").alias("iva_nc_cdo"), capped("st", "mnet").alias("iva_neto_cdo"),
        prop("sf", "mf").alias("prop_fact_cdo"), prop("sn", "mn").alias("prop_nc_cdo"),
        prop("st", "mnet").alias("prop_neto_cdo"), F.lit(hop).alias("hop"), "c_537", "origin")


def _as_result(df: DataFrame) -> DataFrame:
    money = ("f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "iva_fact_cdo", "iva_nc_cdo",
             "iva_neto_cdo", "c_537")
    return df.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c)
                       for c in RESULT_COLS])


def hops_union(results: list[DataFrame]) -> DataFrame:
    """The five hop results; each is unique per (period, receiver, origin)."""
    u = _as_result(results[0])
    for r in results[1:]:
        u = u.unionByName(_as_result(r))
    return u


# ------------------------------------------------------------ summary / pivot
def origin_summary(hops: DataFrame, decl1: DataFrame) -> DataFrame:
    """Per (period, receiver, origin) among declarers: hop count, capped net and proportion of
    each hop, their total and min(1, total / declared net) -- one aggregation."""
    dk = decl1.select(F.col("id").alias("receiver"), "period")
    # one shuffle for the semi join, this aggregate and the one by receiver that reads it: a receiver has 35 rows at most
    h = hops.repartition("receiver", "period").join(dk, ["receiver", "period"], "left_semi")
    g = h.groupBy("period", "receiver", "origin").agg(
        *[F.expr(f"max({c}) AS {c}") for c in ("f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "c_537")], F.expr("count(1) AS qty_arco"),
        *[F.expr(e) for k in range(1, 6) for e in (f"max(CASE WHEN hop = {k} THEN iva_neto_cdo END) AS _v{k}",
                                                   f"max(CASE WHEN hop = {k} THEN prop_neto_cdo END) AS _p{k}",
                                                   f"max(CASE WHEN hop = {k} THEN origin END) AS origin_a{k}")])

    def value(k: int) -> str:
        return f"coalesce(_v{k}, 0)"
    terms = [f"(CASE WHEN {value(k)} > 0 AND {value(k)} > f29_neto_reci THEN f29_neto_reci ELSE {value(k)} END)" for k in range(1, 6)]
    first = f"(CASE WHEN origin_a1 = 3 THEN {value(1)} ELSE {terms[0]} END)"
    capped_total = " + ".join(terms)
    return g.selectExpr(
        "period", "receiver", "origin", "f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "c_537", "qty_arco",
        *[e for k, term in enumerate(terms, 1) for e in (
            f"{term} AS iva_neto_cdo_a{k}", f"CASE WHEN coalesce(_p{k}, 0) > 1 THEN 1.0D ELSE coalesce(_p{k}, 0) END AS prop_neto_cdo_a{k}")],
        f"{' + '.join([first, *terms[1:]])} AS total_cont",
        f"CASE WHEN {capped_total} > f29_neto_reci THEN 1.0D ELSE try_divide(CAST({capped_total} AS DOUBLE), CAST(f29_neto_reci AS DOUBLE)) END AS prop_total_cont",
        *[f"origin_a{k}" for k in range(1, 6)])


def receivers(summary: DataFrame) -> DataFrame:
    """Unique receivers (declarers) with declared maxima, from the rows of their origins."""
    return (summary.groupBy("period", "receiver")
            .agg(F.max("f29_fact_reci").alias("f29_fact_reci"), F.max("f29_nc_reci").alias("f29_nc_reci"),
                 F.max("f29_neto_reci").alias("f29_neto_reci"), F.max("c_537").alias("c_537")))


PIVOT_MEASURES = ([f"iva_neto_cdo_a{k}" for k in range(1, 6)] + [f"prop_neto_cdo_a{k}" for k in range(1, 6)]
                  + ["total_cont", "prop_total_cont"])


def origin_pivot(summary: DataFrame) -> DataFrame:
    """One row per receiver: its declared maxima and the 12 summary measures for each of the
    7 origins (one row each), in one aggregation: a receiver's rows, seven at most, become a map by origin."""
    by_origin = f"map_from_entries(collect_list(struct(origin, struct({', '.join(PIVOT_MEASURES)})))) AS _m"
    out = summary.groupBy("period", "receiver").agg(F.max("f29_neto_reci").alias("f29_neto_reci"), F.max("c_537").alias("c_537"), F.expr(by_origin))
    code = {suffix: k for k, suffix in ORIGIN_SUFFIX.items()}
    return out.selectExpr("period", "receiver", "f29_neto_reci",
                          *[f"_m[{code[sfx]}].{m} AS {m}_{sfx}" for sfx in PIVOT_ORDER for m in PIVOT_MEASURES], "c_537")


def hop_totals(pivot: DataFrame) -> DataFrame:
    """Per hop: sums over the origins except special credit; then grand totals."""
    measures = ("iva_neto_cdo", "prop_neto_cdo")
    out = pivot.selectExpr("*", *[" + ".join(f"coalesce({m}_a{k}_{s}, 0)" for s in TOTAL_ORIGINS) + f" AS {m}_a{k}_an"
                                  for k in range(1, 6) for m in measures])
    return out.selectExpr("*", " + ".join(f"coalesce(iva_neto_cdo_a{k}_an, 0)" for k in range(1, 6)) + " AS total_cont_an",
                          " + ".join(f"prop_neto_cdo_a{k}_an" for k in range(1, 6)) + " AS prop_total_cont_an")


def carried_history_rows(history_p: DataFrame, carry: DataFrame, decl1: DataFrame) -> DataFrame:
    """Carried amounts and every origin's measures of hop 1 and totals, per receiver of the period."""
    c = carry.select("receiver", "period", "period_ant", "f29_77_ant", "prop_total_cont_an_ant",
                     "carried_cont")
    d = decl1.select(F.col("id").alias("receiver"), "period", F.col("c_504").alias("_c504")).distinct()
    j = history_p.join(c, ["receiver", "period"], "left").join(d, ["receiver", "period"], "left")
    cols = ["period", "receiver", "f29_neto_reci", "period_ant", "f29_77_ant", "prop_total_cont_an_ant",
            "carried_cont", F.col("_c504").alias("c_504")]
    for sfx in CARRIED_ORDER + ("an",):
        for k in range(1, 6):
            cols += [f"iva_neto_cdo_a{k}_{sfx}", f"prop_neto_cdo_a{k}_{sfx}"]
        cols += [f"total_cont_{sfx}", f"prop_total_cont_{sfx}"]
    return j.select(*cols)


# ------------------------------------------------------------ one period
@dataclass
class PeriodResult:
    period: int
    decl1: DataFrame
    declared: DataFrame
    carry: DataFrame
    edges: DataFrame
    pedges: DataFrame
    hop1: DataFrame
    hops: list
    union: DataFrame | None = None
    summary: DataFrame | None = None
    recv: DataFrame | None = None
    pivot: DataFrame | None = None
    totals: DataFrame | None = None


def trace_period(decl: DataFrame, obs: DataFrame, ledger: DataFrame, auth: DataFrame,
                 alerts: DataFrame, period: int, history: DataFrame | None = None,
                 phantom_origins: bool = True, checkpoint: bool = True, hops: int = 5) -> PeriodResult:
    """Run the credit tracing of one period. ``history`` holds earlier
    periods' hop totals (period, receiver, total_cont_an, prop_total_cont_an).
    With ``hops`` of 0 it ends at the edges of hop 1, with 1 at hop 1's result; the
    summary and what follows need all five.

    Every reused intermediate is cut into a leaf in the checkpoint folder:
    DataFrame analysis is eager and a shared subtree would otherwise be
    re-analysed by every later step (the hop chain would grow combinatorially).
    Two leaves are hash-partitioned once and reused by every hop without a
    new shuffle: the salted hop edges on (issuer, period, _salt) and the
    declarations on (id, period). Edge-level joins by receiver use the plain
    declarations instead, so both sides shuffle and AQE can split a hot
    receiver."""
    leaf = kept if checkpoint else (lambda df: df)

    def by_key(df: DataFrame, *keys: str) -> DataFrame:
        return cut_partitioned(df, *keys) if checkpoint else df
    prior = prior_period_int(period)
    cur = decl_current(decl, period)
    fm = observations(obs, OBS_FM01, period)
    decl1 = leaf(decl_adjust_fm01(cur, fm))
    prev_decl = decl_prior(decl, prior)
    carry = leaf(carry_in(decl1, prev_decl, period, prior, history))
    edges = leaf(trade_edges_clamped(trade_edges(ledger_docs(ledger, period), decl1)))
    declared = leaf(decl_or_ledger(decl1, edges))
    nondecl = nondeclaring_issuers(edges, declared).select("issuer", "period").distinct()
    seeds = seed_table(doc30_issuers(ledger, auth, period), nondecl, alerted_issuers(edges, alerts))
    pedges = leaf(phantom_edges(edges, special_credit(declared, period),
                                observations(obs, OBS_W08, period), carry, fm))
    hop1 = hop1_by_origin(edge_level0(pedges), declared, seeds, phantom_origins)
    out = PeriodResult(period, decl1, declared, carry, edges, pedges, hop1, [])
    if hops == 0:
        return out
    declared_by_id = by_key(declared, "id", "period")
    results = out.hops
    results.append(leaf(hop1_result(hop1, declared_by_id)))
    if hops == 1:
        return out
    hedges, hot = hop_edges(pedges, leaf)
    hedges = by_key(hedges, *salt_keys(["issuer", "period"], hot))
    for k in range(2, 6):
        results.append(leaf(hop_next(hedges, results[-1], declared_by_id, k, hot)))
    out.union = hops_union(results)
    out.summary = origin_summary(out.union, decl1)
    out.recv = receivers(out.summary)
    out.pivot = origin_pivot(out.summary)
    out.totals = hop_totals(out.pivot)
    return out


# ------------------------------------------------------------ all periods
@dataclass
class Ground:
    """What no period needs another one for, of all periods at once: tables in folders by period.

    declared is bucketed on the taxpayer, hop_edges on the issuer (and salt); hop1 has the sums of hop 1
    over the normal edges, phantom the rows of hop 1 of self edges without carried credit."""

    decl1: DataFrame
    inputs: DataFrame
    declared: DataFrame
    seeds: DataFrame
    hop1: DataFrame
    phantom: DataFrame
    hop_edges: DataFrame
    hot: DataFrame | None

    def of(self, name: str, period: int) -> DataFrame:
        return getattr(self, name).where(_c("period") == period)

    def release(self) -> None:
        """Remove the tables; nothing reads them after the last period."""
        for table in (self.decl1, self.inputs, self.declared, self.seeds, self.hop1, self.phantom, self.hop_edges):
            release(table)


def _by_period(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in folders by period; the rows of a period are dealt to its files by AQE's rebalancing."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.hint("rebalance", "period").write.partitionBy("period").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._vatlens_table = (None, path)
    return out


def _in(df: DataFrame, wanted: list[int] | None) -> DataFrame:
    return df if wanted is None else df.where(_c("period").isin(wanted))


def ground(decl: DataFrame, obs: DataFrame, ledger: DataFrame, auth: DataFrame, alerts: DataFrame,
           phantom_origins: bool = True, periods: list[int] | None = None) -> Ground:
    """One pass over all periods: declarations, edges, seeds and the part of hop 1 that no carried credit enters.
    The ledger is read for the edges and for the issuers of type 30, once each. With ``periods`` only those are
    prepared (with the declarations of the periods before them): a trace that ends early reads no later rows.
    Tables that do not need each other are written side by side; those that nothing reads later go at the end."""
    before = periods and sorted(map(prior_period_int, periods))
    obs, ledger = _in(obs, periods), _in(ledger, periods)

    def declarations():
        fm = kept(observations(obs, OBS_FM01, None))
        return fm, _by_period(decl_adjust_fm01(decl_current(_in(decl, periods), None), fm), "decl1")
    (fm, decl1), sums = together(declarations, lambda: kept(trade_sums(ledger_docs(ledger, None))))
    prior = decl_prior(_in(decl, before), None)
    after = F.when(_c("period_ant") % 100 == 12, _c("period_ant") + 89).otherwise(_c("period_ant") + 1).cast("int")
    inputs, edges = together(
        lambda: _by_period(carry_inputs(decl1, prior.select("id", after.alias("period"), "f29_77_ant")), "inputs"),
        lambda: kept(trade_edges_clamped(trade_edges(sums, decl1, summed=True))))
    release(sums)
    normal = edges.withColumn("node_kind", F.lit(NORMAL)).withColumn("iva_neto", _c("iva_neto").cast("double"))
    most = edges.groupBy("period").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    n = buckets_of(most, decl.sparkSession.sparkContext.defaultParallelism)

    def receivers_side():
        declared = kept(decl_or_ledger(decl1, edges))
        nondecl = nondeclaring_issuers(edges, declared).select("issuer", "period").distinct()
        selfs = self_edges(special_credit(declared, None), observations(obs, OBS_W08, None), fm).distinct() \
            .withColumn("iva_neto", _c("iva_neto").cast("double"))

        def first_hop():
            seeds = _by_period(seed_table(doc30_issuers(ledger, auth, None), nondecl, alerted_issuers(edges, alerts)), "seeds")
            return (seeds, *together(
                lambda: _by_period(hop1_sums(hop1_by_origin(edge_level0(normal), declared, seeds, phantom_origins)), "hop1"),
                lambda: _by_period(hop1_by_origin(edge_level0(selfs), declared, seeds, phantom_origins), "phantom")))
        out = together(first_hop, lambda: bucketed(declared, ["id"], n, "period"))
        release(declared)
        return out

    def later_hops():
        salted, hot = hop_edges(normal, kept)
        return bucketed(salted, salt_keys(["issuer"], hot), n, "period"), hot
    ((seeds, hop1, phantom), by_id), (hedges, hot) = together(receivers_side, later_hops)
    release(edges)
    release(fm)
    return Ground(decl1, inputs, by_id, seeds, hop1, phantom, hedges, hot)


#: Edges of a period in one bucket, at most and (while cores would be idle) at least.
BUCKET_ROWS, LEAST_BUCKET_ROWS = 100_000, 10_000


def buckets_of(rows: int, cores: int) -> int:
    """Buckets of the tables of the hops, for ``rows`` edges of a period."""
    return max(rows // BUCKET_ROWS, min(cores, rows // LEAST_BUCKET_ROWS)) + 1


def trace_carried(g: Ground, period: int, history: DataFrame | None, phantom_origins: bool = True) -> tuple[DataFrame, DataFrame, list[str]]:
    """Hop totals of one period from ``ground`` and the history, its carry, and the folders that both read: only
    what carried credit reaches is computed here. Every hop's result is a small table in the shared
    folder, so a lost executor costs its running tasks only; its money is DOUBLE there, half as many bytes."""
    declared, kept = g.of("declared", period), []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(scratch_path(df.sparkSession, "hop"))
        df.write.parquet(kept[-1])
        return df.sparkSession.read.schema(df.schema).parquet(kept[-1])
    carry = keep(carry_of(g.of("inputs", period), period, prior_period_int(period), history))
    brought = hop1_by_origin(edge_level0(carried_edges(carry).distinct()), declared, g.of("seeds", period), phantom_origins)
    rows = g.of("phantom", period)
    fitted = brought.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    sums = hop1_sums(rows.unionByName(fitted).distinct())
    normal = g.of("hop1", period)
    both = normal.unionByName(sums.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in normal.schema.fields]))
    measures = [c for c in both.columns if c.startswith("s_")]
    first = hop1_capped(both.groupBy("period", "receiver", "origin").agg(*[F.sum(c).alias(c) for c in measures]), declared, by_period=False)
    results = [keep(_as_result(first))]
    edges = g.of("hop_edges", period)
    for k in range(2, 6):
        results.append(keep(_as_result(hop_next(edges, results[-1], declared, k, g.hot, by_period=False))))
    return hop_totals(origin_pivot(origin_summary(hops_union(results), g.of("decl1", period)))), carry, kept
