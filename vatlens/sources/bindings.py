"""TESTDATA tables -> the input schemas the operators read (see FIXTURES.md).

This is the only module that knows the TPC-H-ish table names. Every binding
is a DataFrame over the parquet files, written as a table when a query first needs it
(see ``Bindings``), so its size grows with the scale factor. Money is DECIMAL(18,2) so that sums are exact whatever the order of
summation (the operators also accept DOUBLE).

One id space: taxpayer ``k`` is customer ``k`` and, for small ``k``, also
supplier ``k``; so low ids both issue and receive, which gives multi-hop paths.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from decimal import Decimal
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vatlens.plans.iterate import cut, shuffles_removed
from vatlens.plans.skew import shuffle_partitions
from vatlens.sources.tables import folder_state, read_table

MONEY = "decimal(18,2)"


def D(x) -> F.Column:
    """Exact decimal literal (``F.lit(1.1)`` would be a DOUBLE)."""
    return F.lit(Decimal(str(x)))


#: Lines that a task of a shuffle over all lines takes.
LINES_PER_TASK = 500_000

_MATERIALISED: dict[tuple, str] = {}
#: One for each table: of several threads that need it, one writes it. A builder asks for other tables only.
_LOCKS: defaultdict[tuple, Lock] = defaultdict(Lock)


class Bindings:
    """Lazily built input tables for one scale-factor folder.

    With ``materialise=True`` (default) each derived input is written once per
    Spark application as parquet under the session's checkpoint folder and read
    back, i.e. it becomes a table as the inputs are in production: later
    queries scan it with pushdown and pruning instead of re-deriving it. Tables are known
    by application, folder and the state of the folder's files: changed files give new ones.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialise: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialise = materialise
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        builder = getattr(type(self), "_b_" + name, None)
        if builder is None:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._table(name, builder) if self.materialise else builder(self)
        return self._cache[name]

    def _table(self, name: str, builder) -> DataFrame:
        from vatlens.session import ensure_checkpoint_dir
        key = (*self.key(), name)
        with _LOCKS[key]:
            path = _MATERIALISED.get(key)
            if path is None:
                root = ensure_checkpoint_dir(self.spark)
                tag = hashlib.sha1(repr(key[1:3]).encode()).hexdigest()[:12]
                path = f"{root.rstrip('/')}/vatlens-inputs/{key[0]}/{tag}/{name}"
                rows = builder(self)
                with shuffles_removed(self.spark):
                    rows.write.mode("overwrite").parquet(path)
                _MATERIALISED[key] = path
        return self.spark.read.parquet(path)

    def key(self) -> tuple:
        """Application, folder, and the state of its files."""
        return self.spark.sparkContext.applicationId, self.sf_dir, folder_state(self.spark, self.sf_dir)

    def derived(self, name: str, build) -> DataFrame:
        """``build(self)`` as a table that several queries serve from."""
        if name not in self._cache:
            self._cache[name] = self._table(name, build)
        return self._cache[name]

    # ---- shared pieces -------------------------------------------------
    def _n_customers(self) -> F.Column:
        return self.raw("customer").select(F.count(F.lit(1))).scalar()

    def _lines(self) -> DataFrame:
        li = self.raw("lineitem").select(
            "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        n = self._partitions()
        if n:
            li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
        return li.join(o, li.l_orderkey == o.o_orderkey)

    def _partitions(self) -> int | None:
        """Partitions of a shuffle of all lines, ``LINES_PER_TASK`` each, so that a task's sort or hash table
        stays as large however many lines there are; None while the session's own number gives no more."""
        n = -(-self.raw("lineitem").count() // LINES_PER_TASK)       # from the footers
        return n if n > shuffle_partitions(self.raw("lineitem")) else None

    @staticmethod
    def _line_vat6() -> F.Column:
        return (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * F.col("l_tax")) \
            .cast("decimal(18,6)")

    def _owner_orders(self) -> DataFrame:
        n = self._n_customers()
        return (self.raw("orders")
                .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
                .where(F.col("o_custkey") < n * 0.6)
                .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                        ((F.col("o_orderkey") * 7 + 3) % n).alias("partner"))
                .where(F.col("partner") > F.col("o_custkey")))

    # ---- 2.7 arcs and communities -------------------------------------
    def _b_arcs(self) -> DataFrame:
        lines = (self._lines()
                 .select(F.col("l_suppkey").alias("issuer"), F.col("o_custkey").alias("receiver"),
                         self._line_vat6().alias("v6"))
                 .where(F.col("issuer") != F.col("receiver")))
        n = self._partitions()
        if n:                                     # most pairs have few lines: they are combined after the shuffle
            lines = lines.repartition(n, "issuer", "receiver")
        return (lines.groupBy("issuer", "receiver")
                .agg(F.round(F.sum("v6"), 2).cast(MONEY).alias("vat"))
                .where(F.col("vat") > 0))

    def _b_communities(self) -> DataFrame:
        c = self.raw("customer")
        seg = F.col("c_mktsegment")
        return c.select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("int"))
             .otherwise(F.col("c_nationkey")).alias("community"),
            F.when(seg.isin("AUTOMOBILE", "BUILDING", "MACHINERY"), 1).otherwise(0).alias("is_company"),
            F.when(seg.isin("AUTOMOBILE", "BUILDING", "MACHINERY"), 0).otherwise(1).alias("is_natural"),
            F.when(seg == "HOUSEHOLD", 1).otherwise(0).alias("is_accountant"),
            F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0).alias("is_rep"),
            F.when(F.col("c_custkey") % 3 == 0, (F.col("c_custkey") % 40).cast("int"))
             .alias("initial_group"),
        )

    def _b_strength(self) -> DataFrame:
        # totals as a table of their own: both join sides are plain shuffles, and AQE splits a hub receiver
        totals = cut(self.arcs.groupBy("receiver").agg(F.sum("vat").alias("tot")))
        a = self.arcs.join(totals, "receiver")
        fi = F.round(F.col("vat").cast("double") / F.col("tot").cast("double"), 6)
        k = F.col("issuer") + F.col("receiver")
        return a.select(
            "issuer", "receiver",
            F.when(k % 97 == 0, F.lit(1.0))
             .when((F.col("issuer") * 3 + F.col("receiver")) % 89 == 0, F.lit(0.0))
             .otherwise(fi).alias("fi"))

    # ---- 2.1 / 2.2 ownership, seeds, kinship ---------------------------
    def _b_ownership(self) -> DataFrame:
        cap = (F.lit(1) + F.floor(F.col("o_totalprice")) % 100).cast("double")
        return self._owner_orders().select(
            F.col("o_custkey").alias("company"), F.col("partner"),
            cap.alias("capital"), cap.alias("profit"))

    def _b_opacity_seed(self) -> DataFrame:
        own = self.ownership.where(F.col("capital") != 0)
        companies = own.select(F.col("company").alias("id")).distinct()
        partners = own.select(F.col("partner").alias("id")).distinct()
        return (partners.join(companies, "id", "left_anti")
                .where(F.col("id") % 11 != 0)
                .select("id", ((F.col("id") % 10) / 10.0).alias("value")))

    def _b_kinship(self) -> DataFrame:
        w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
        base = (self._owner_orders()
                .select("o_orderkey", "o_orderstatus", F.col("partner").alias("id"),
                        F.lead("partner").over(w).alias("relative"),
                        F.row_number().over(w).alias("rn"))
                .where(F.col("relative").isNotNull() & (F.col("rn") % 2 == 1))
                .select("o_orderkey", "id", "relative",
                        F.when(F.col("o_orderstatus") == "F", "SPOUSE")
                         .when(F.col("o_orderstatus") == "O", "CHILD")
                         .otherwise("SIBLING").alias("relation")))
        k = F.col("o_orderkey")
        return (base.select("id", "relative", "relation")
                .unionByName(base.where(k % 29 == 0).select("id", F.col("id").alias("relative"),
                                                            F.lit("SELF").alias("relation")))
                .unionByName(base.where(k % 3 == 0).select(F.col("relative").alias("id"),
                                                           F.col("id").alias("relative"), "relation"))
                .unionByName(base.where(k % 5 == 0).select("id", "relative", "relation")))

    def _b_groups(self) -> DataFrame:
        c = self.raw("customer").where(F.col("c_custkey") % 3 == 0)
        g = c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 40).cast("int").alias("grp"))
        return g.unionByName(g.where(F.col("id") % 6 == 0))

    # ---- 2.3 / 2.4 alerts, invoices, businesses, taxpayers --------------
    def _b_alerts(self) -> DataFrame:
        e = self.raw("events").where((F.col("event_type") == "error")
                                     & ((F.col("user_id") % 10 == 3) | (F.col("value") > 250)))
        eid = F.col("event_id")
        code = F.when(eid % 9 == 0, F.lit("4200")).otherwise(
            F.concat(F.lit("411"), (eid % 4).cast("string")))
        return e.select(
            F.col("user_id").alias("id"), code.alias("code"),
            F.concat(F.lit("ALERT "), code).alias("description"),
            F.when(eid % 2 == 1, F.col("ts")).alias("deactivated"),
            F.when(eid % 3 == 0, F.concat(F.lit("U"), (eid % 5).cast("string"))).alias("deactivated_by"),
            F.when(eid % 7 == 0, eid).alias("unblock_folio"))

    def _b_invoices(self) -> DataFrame:
        return self._lines().select(
            F.col("l_suppkey").alias("issuer"), F.col("o_custkey").alias("receiver"),
            F.round(self._line_vat6(), 2).cast(MONEY).alias("vat"),
            F.col("l_extendedprice").cast(MONEY).alias("total"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("issue_date"),
            F.when(F.col("l_returnflag") == "R", "61").when(F.col("l_linestatus") == "O", "33")
             .otherwise("34").alias("doc_code"))

    def _b_businesses(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 25).cast("int").alias("unit"),
            F.col("o_orderdate").alias("valid_from"))

    def _b_units(self) -> DataFrame:
        n = self.raw("nation")
        r = self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").alias("unit"),
            F.concat_ws(" - ", "r_name", "n_name").alias("region"))

    def _b_taxpayers(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey")
        first = self.raw("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
        k = F.col("c_custkey")
        return c.join(first, c.c_custkey == first.o_custkey, "left").select(
            k.alias("id"),
            F.when(k % 17 == 0, F.lit(None).cast("timestamp"))
             .when(k % 23 == 0, F.lit("2999-01-01 00:00:00").cast("timestamp"))
             .otherwise(F.col("d")).alias("start_date"))

    # ---- 2.5 workers -----------------------------------------------------
    @staticmethod
    def _annual_period() -> F.Column:
        eid = F.col("event_id")
        return (F.when(eid % 11 == 0, 201900).when(eid % 3 == 0, 202000)
                .when(eid % 3 == 1, 202100).otherwise(202200))

    PAYROLL_AMOUNTS = (
        "income_exempt_total", "income_net", "tax_withheld", "extra_withheld", "income_exempt",
        "zone_rebate", "income_m01", "income_m02", "income_m03", "income_m04", "income_m05",
        "income_m06", "income_m07", "income_m08", "income_m09", "income_m10", "income_m11",
        "income_m12",
    )

    def _b_payroll(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type").isin("purchase", "signup"))
        v = F.col("value").cast(MONEY)
        return e.select(
            F.col("user_id").alias("id"), (F.col("user_id") % 10).cast("string").alias("dv"),
            self._annual_period().alias("period"), (F.col("event_id") % 37).alias("worker"),
            *[(v * (i + 1)).cast(MONEY).alias(name) for i, name in enumerate(self.PAYROLL_AMOUNTS)])

    def _b_fees(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type").isin("view", "click"))
        return e.select(
            F.col("user_id").alias("id"), self._annual_period().alias("period"),
            (F.col("event_id") % 41).alias("worker"), F.col("value").cast(MONEY).alias("withheld"))

    def _b_networth(self) -> DataFrame:
        return (self.raw("orders").where(F.col("o_orderkey") % 4 == 0)
                .select(F.col("o_custkey").alias("company"),
                        F.col("o_totalprice").cast(MONEY).alias("amount")))

    def _b_invoice_points(self) -> DataFrame:
        return self._lines().select(F.col("l_suppkey").alias("issuer"),
                                    (F.col("o_orderkey") % 25).cast("int").alias("point"))

    def _b_point_regions(self) -> DataFrame:
        n = self.raw("nation")
        r = self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").alias("point"), F.col("r_name").alias("region"))

    # ---- 2.6 ledger, declarations, observations, authorisations ---------
    def _b_ledger(self) -> DataFrame:
        rf, ln = F.col("l_returnflag"), F.col("l_linenumber")
        return self._lines().select(
            (F.col("l_orderkey") * 10 + ln).alias("doc_id"),
            (F.lit(200000) + F.month("o_orderdate")).cast("int").alias("period"),
            F.when(rf == "R", 61).when((rf == "N") & (F.col("l_suppkey") % 17 == 0), 30)
             .otherwise(33).alias("doc_type"),
            F.col("l_suppkey").alias("issuer"), F.col("o_custkey").alias("receiver"),
            (F.lit(1) + ln % 7).cast("int").alias("tx_type"),
            F.when(ln == 7, "VENTA").otherwise("COMPRA").alias("operation"),
            F.round(self._line_vat6(), 2).cast(MONEY).alias("vat"))

    DECL_CODES = ("c_77", "c_89", "c_126", "c_160", "c_502", "c_503", "c_504", "c_509", "c_510",
                  "c_519", "c_520", "c_525", "c_528", "c_532", "c_535", "c_537", "c_538", "c_553",
                  "c_572", "c_704", "c_725", "c_762", "c_766", "c_767", "c_768")

    def _b_declarations(self) -> DataFrame:
        lg = self.ledger
        is_nc = F.col("doc_type") == 61
        s = (lg.groupBy(F.col("receiver").alias("id"), "period")
             .agg(F.sum(F.when(~is_nc, F.col("vat")).otherwise(D(0))).alias("inv"),
                  F.sum(F.when(is_nc, F.col("vat")).otherwise(D(0))).alias("nc"),
                  F.count(F.when(~is_nc, 1)).alias("n_inv"),
                  F.count(F.when(is_nc, 1)).alias("n_nc"),
                  F.max(F.floor(F.col("doc_id") / 10)).alias("fmax"),
                  F.min(F.floor(F.col("doc_id") / 10)).alias("fmin"))
             .where((F.col("id") * 31 + F.col("period")) % 10 != 0))
        i, inv, nc = F.col("id"), F.col("inv"), F.col("nc")

        def m(x, cond=None, dec=2):
            v = F.round(inv * D(x), dec).cast(MONEY)
            return F.when(cond, v) if cond is not None else v

        def const(x, cond):
            return F.when(cond, D(x).cast(MONEY))

        codes = {
            "c_77": F.when(i % 3 == 0, m(0.1)).otherwise(D(0).cast(MONEY)),
            "c_89": m(0.19),
            "c_126": const(0.5, i % 45 == 0),
            "c_160": const(3, i % 9 == 0),
            "c_502": m(1.2),
            "c_503": F.col("n_inv").cast("int"),
            "c_504": F.when(i % 2 == 0, ((i % 6) * 10 + 5).cast(MONEY)),
            "c_509": F.col("n_nc").cast("int"),
            "c_510": nc.cast(MONEY),
            "c_519": F.col("n_inv").cast("int"),
            "c_520": m(0.9),
            "c_525": m(0.02, i % 5 == 0),
            "c_528": F.round(nc * D(0.8), 2).cast(MONEY),
            "c_532": const(1.5, i % 7 == 0),
            "c_535": const(0.75, i % 13 == 0),
            "c_537": F.when(i % 19 == 0, D(0).cast(MONEY)).otherwise((m(1.1) + D(50)).cast(MONEY)),
            "c_538": m(0.5),
            "c_553": const(2.25, i % 11 == 0),
            "c_572": const(2, i % 36 == 0),
            "c_704": const(1, i % 27 == 0),
            "c_725": const(12.5, i % 9 == 0),
            "c_762": m(0.05, i % 4 == 0),
            "c_766": m(0.03, i % 6 == 0),
            "c_767": const(4, i % 18 == 0),
            "c_768": const(6, i % 9 == 0),
        }
        main = s.select(
            "id", (F.col("fmax") * 10).alias("folio"), "period",
            F.when(i % 8 == 0, 3).otherwise(1).alias("validity"),
            *[codes[c].alias(c) for c in self.DECL_CODES])
        dup = (s.where((F.col("fmin") < F.col("fmax")) & (i % 4 == 1))
               .select("id", (F.col("fmin") * 10 + 1).alias("folio"), "period",
                       F.when(i % 8 == 0, 3).otherwise(1).alias("validity"),
                       *[(m(0.45) if c == "c_520" else codes[c]).alias(c) for c in self.DECL_CODES]))
        invalid = (s.where(i % 10 == 3)
                   .select("id", (F.col("fmax") * 10 + 2).alias("folio"), "period",
                           F.lit(2).alias("validity"),
                           *[(D(99999).cast(MONEY) if c == "c_537" else codes[c]).alias(c)
                             for c in self.DECL_CODES]))
        return main.unionByName(dup).unionByName(invalid)

    def _b_observations(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type").isin("view", "click"))
        g = (e.groupBy(F.col("user_id").alias("id"),
                       (F.lit(200001) + F.col("event_id") % 12).cast("int").alias("period"),
                       F.when(F.col("event_type") == "view", "FM01").otherwise("W08").alias("code"))
             .agg(F.sum(F.col("value").cast(MONEY)).alias("amount"),
                  F.max("event_id").alias("emax"), F.min("event_id").alias("emin"),
                  F.max("ts").alias("tmax")))
        return g.select(
            "id", "period", "code", F.col("amount").cast(MONEY).alias("amount"),
            F.when(F.col("emax") % 6 == 0, F.col("tmax")).alias("end_date"),
            F.when(F.col("emin") % 10 == 0, "N").otherwise("V").alias("status"))

    def _b_authorisations(self) -> DataFrame:
        s = self.raw("supplier").select(F.col("s_suppkey").alias("id"))
        k = F.col("id")
        pofe = s.where((k % 2 == 0) | (k % 5 == 0)).select(
            "id", F.lit("POFE").alias("attribute"),
            F.when(k % 2 == 1, F.lit("2001-01-01 00:00:00").cast("timestamp")).alias("end_date"))
        other = s.where(k % 3 == 0).select(
            "id", F.lit("OTHR").alias("attribute"), F.lit(None).cast("timestamp").alias("end_date"))
        return pofe.unionByName(other)


def bind(spark: SparkSession, sf_dir: str) -> Bindings:
    return Bindings(spark, sf_dir)
