"""2.4 Taxpayer labels and 2.5 workers.

Each label is one aggregate keyed by taxpayer, so the final chain of left
joins never fans out, and every join after the first reuses the hash
partitioning on the taxpayer id. Newest-row-per-key picks use ``max_by`` over
an ordering struct instead of a window: it aggregates partially on the map
side, so a taxpayer owning a third of the rows does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC_INVOICE_CODES = ("33", "34")


def _since_ts(since: str):
    return F.to_timestamp(F.lit(since), "yyyy-MM-dd")


def _since_int(since: str) -> int:
    """``since`` as a yyyyMMdd integer: a bound implied by the exact date test
    that the parquet scan can push down (row-group skipping on date columns)."""
    return int(since.replace("-", ""))


def paid_total(decl: DataFrame, since: str) -> DataFrame:
    """Valid declarations (validity 1) of periods from ``since`` on: sum of code 89 per taxpayer."""
    d = decl.where((F.col("validity") == 1) & (F.col("period") >= _since_int(since) // 100)).select(
        "id", "c_89",
        F.to_timestamp(F.concat(F.col("period").cast("string"), F.lit("01")), "yyyyMMdd").alias("fecha"))
    return (d.where(F.col("fecha") >= _since_ts(since))
            .groupBy("id").agg(F.sum("c_89").alias("paid_total")))


def vat_net(invoices: DataFrame, since: str) -> DataFrame:
    """Invoices 33/34 since a date: VAT issued and received per taxpayer (0 when absent),
    net = received - issued. One pass: each document feeds its issuer and its receiver."""
    inv = invoices.where(F.col("doc_code").isin(*DOC_INVOICE_CODES)
                         & (F.col("issue_date") >= _since_int(since))).where(
        F.to_timestamp(F.col("issue_date").cast("string"), "yyyyMMdd") >= _since_ts(since))
    sides = inv.select(F.inline(F.array(
        F.struct(F.col("issuer").alias("id"), F.col("vat").alias("issued"),
                 F.lit(None).cast(inv.schema["vat"].dataType).alias("received")),
        F.struct(F.col("receiver").alias("id"), F.lit(None).cast(inv.schema["vat"].dataType).alias("issued"),
                 F.col("vat").alias("received")))))
    g = sides.groupBy("id").agg(F.coalesce(F.sum("issued"), F.lit(0)).alias("vat_issued"),
                                F.coalesce(F.sum("received"), F.lit(0)).alias("vat_received"))
    return g.select("id", "vat_issued", "vat_received",
                    (F.col("vat_received") - F.col("vat_issued")).alias("vat_net"))


def latest_region(businesses: DataFrame, units: DataFrame) -> DataFrame:
    """Region of each taxpayer's newest business (ties: lowest unit)."""
    newest = businesses.groupBy("id").agg(
        F.max_by("unit", F.struct(F.col("valid_from"), -F.col("unit"))).alias("unit"),
        F.max("valid_from").alias("valid_from"))
    return newest.join(units, "unit", "left").select("id", "region", "valid_from")


def docs_issued(invoices: DataFrame) -> DataFrame:
    """Number of 33/34 documents per issuer (no date filter)."""
    return (invoices.where(F.col("doc_code").isin(*DOC_INVOICE_CODES))
            .groupBy(F.col("issuer").alias("id")).agg(F.count(F.lit(1)).alias("n_documents")))


def lifetime_days(taxpayers: DataFrame, today: str) -> DataFrame:
    """Days since start of activity; NULL when unknown or in the future."""
    t = F.to_timestamp(F.lit(today))
    s = F.col("start_date")
    return taxpayers.select("id", F.when(s.isNull() | (s > t), F.lit(None))
                            .otherwise(F.datediff(t, s)).alias("lifetime"))


def initial_alert_flag(ids: DataFrame, seeds: DataFrame, id_col: str = "id") -> DataFrame:
    """1 if the taxpayer is a seed (semi-join semantics; seeds are distinct ids)."""
    s = seeds.select(F.col(id_col).alias("_sid")).distinct().withColumn("_hit", F.lit(1))
    j = ids.join(s, ids[id_col] == s["_sid"], "left")
    return j.select(*[ids[c] for c in ids.columns],
                    F.when(F.col("_hit").isNull(), 0).otherwise(1).alias("initial_alert"))


def contam_labels(scores: DataFrame, seeds: DataFrame, decl: DataFrame, invoices: DataFrame,
                  businesses: DataFrame, units: DataFrame, taxpayers: DataFrame,
                  since: str, today: str) -> DataFrame:
    """Score, paid, VAT net, region, documents, lifetime and initial alert per taxpayer."""
    base = scores.select("id", "score")
    out = (base.join(paid_total(decl, since), "id", "left")
           .join(vat_net(invoices, since).select("id", "vat_net"), "id", "left")
           .join(latest_region(businesses, units).select("id", "region"), "id", "left")
           .join(docs_issued(invoices), "id", "left")
           .join(lifetime_days(taxpayers, today), "id", "left"))
    return initial_alert_flag(out, seeds)


# ------------------------------------------------------------------ workers
PAYROLL_PERIODS = (202000, 202100, 202200)


def payroll_period(payroll: DataFrame, amounts: list[str], periods=PAYROLL_PERIODS) -> DataFrame:
    """Per (taxpayer, check digit, period): distinct workers and the sums of the amounts."""
    p = payroll.where(F.col("period").isin(*periods))
    return p.groupBy("id", "dv", "period").agg(
        F.countDistinct("worker").alias("dependent_workers"),
        *[F.sum(a).alias(a) for a in amounts])


def _newest(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.max("period").alias("period"),
        *[F.max_by(c, F.col("period")).alias(c) for c in cols])


def payroll_latest(pp: DataFrame) -> DataFrame:
    """Newest period per (taxpayer, check digit)."""
    return _newest(pp, ["id", "dv"], ["dependent_workers"])


def fee_workers(fees: DataFrame, first: int = 202000, last: int = 202200) -> DataFrame:
    """Per (taxpayer, period): distinct fee workers and withheld total."""
    f = fees.where(F.col("period").between(first, last))
    return f.groupBy("id", "period").agg(F.countDistinct("worker").alias("fee_workers"),
                                        F.sum("withheld").alias("fee_total"))


def fee_latest(fw: DataFrame) -> DataFrame:
    return _newest(fw, ["id"], ["fee_workers"])


def workers_last(fee_last: DataFrame, payroll_last: DataFrame) -> DataFrame:
    """Outer combination of the newest fee and payroll counts, NULL -> 0 (one row per id)."""
    pl = payroll_last.groupBy("id").agg(F.max_by("dependent_workers", F.col("period"))
                                        .alias("dependent_workers"))
    j = fee_last.select("id", "fee_workers").join(pl, "id", "full_outer")
    return j.select("id", F.coalesce("fee_workers", F.lit(0)).alias("fee_workers"),
                    F.coalesce("dependent_workers", F.lit(0)).alias("dependent_workers"))
