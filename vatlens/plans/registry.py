"""

Each binds the TESTDATA tables of ``sf_dir`` to the operator inputs and runs
the operator over the whole tables. DECIMAL money is cast to DOUBLE at the
end so the schema matches the SQL twins in ``vatlens.sql.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vatlens.functions.expr import decimals_to_double
from vatlens.operators import flows, views
from vatlens.plans.iterate import cut, kept, together
from vatlens.sources.bindings import bind

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(bind(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- 2.7 flows
def _tagged(b):
    return flows.arcs_tagged(b.arcs, b.communities)


@query("arcs_tagged")
def _q_arcs_tagged(b):
    return _tagged(b)


@query("flow_issuer")
def _q_flow_issuer(b):
    return flows.flow_issuer(_tagged(b))


@query("flow_receiver")
def _q_flow_receiver(b):
    return flows.flow_receiver(_tagged(b))


@query("taxpayer_flow")
def _q_taxpayer_flow(b):
    return flows.taxpayer_flow(_tagged(b))


@query("community_flow")
def _q_community_flow(b):
    return flows.community_flow(_tagged(b))


@query("community_ratios")
def _q_community_ratios(b):
    return flows.community_ratios(flows.community_flow(_tagged(b)))


@query("community_size")
def _q_community_size(b):
    ratios = flows.community_ratios(flows.community_flow(_tagged(b)))
    return flows.community_size(ratios, b.communities)


@query("networth")
def _q_networth(b):
    return flows.networth(b.networth)


# ---------------------------------------------------------------- 2.8 views
LOOKUP_ID = " 1 2 "
FLOW_MONEY = ["vat_intra_issued", "vat_extra_issued", "vat_intra_received", "vat_extra_received"]


#: Columns shown as money in each frame of a lookup.
COMMUNITY_MONEY = ["issued_intra", "issued_extra", "received_intra", "received_extra"]
MONEY_COLUMNS = ["paid_total", "vat_net", "networth", "carried_cont", *FLOW_MONEY, *COMMUNITY_MONEY]


def _served(b):
    """The three tables that lookups serve from: 360 with carried credit, taxpayer flows, communities."""
    def communities(x):
        return flows.community_size(flows.community_ratios(flows.community_flow(_tagged(x))), x.communities)

    return together(
        lambda: b.derived("served_360", lambda x: rounded(decimals_to_double(_t360_carried(x)))),
        lambda: b.derived("served_flow", lambda x: decimals_to_double(flows.taxpayer_flow(_tagged(x)))),
        lambda: b.derived("served_community", lambda x: decimals_to_double(communities(x))))


@query("lookup_taxpayer")
def _q_lookup_taxpayer(b):
    return rounded(views.lookup_taxpayer(*_served(b), LOOKUP_ID))


@query("lookup_unpivot")
def _q_lookup_unpivot(b):
    from pyspark.sql import functions as F
    out = None
    for name, frame in zip(("taxpayer", "flow", "community"), views.lookup_frames(*_served(b), LOOKUP_ID)):
        text = views.format_money(rounded(frame), MONEY_COLUMNS)
        text = text.select([views.number_text(c).alias(c) if t == "double" else F.col(c) for c, t in text.dtypes])
        pairs = views.unpivot_row(text).select(F.lit(name).alias("frame"), "attribute", "value")
        out = pairs if out is None else out.unionByName(pairs)
    return out


@query("money_format")
def _q_money_format(b):
    tf = decimals_to_double(flows.taxpayer_flow(_tagged(b)))
    return views.format_money(tf.select("taxpayer", *FLOW_MONEY), FLOW_MONEY)


@query("intra_extra_share")
def _q_intra_extra_share(b):
    tf = flows.taxpayer_flow(_tagged(b)).select("taxpayer", *FLOW_MONEY)
    return views.intra_extra_share(tf, {
        "issued": ("vat_intra_issued", "vat_extra_issued"),
        "received": ("vat_intra_received", "vat_extra_received")})


@query("intra_extra_share_community")
def _q_intra_extra_share_community(b):
    cf = flows.community_flow(_tagged(b)).select(
        "com", "issued_intra", "issued_extra", "received_intra", "received_extra")
    return views.intra_extra_share(cf, {
        "issued": ("issued_intra", "issued_extra"),
        "received": ("received_intra", "received_extra")})


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round DOUBLE columns: sums of doubles depend on summation order in the last bits."""
    from pyspark.sql import functions as F
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if f.dataType.simpleString() == "double" else F.col(f.name)
                      for f in df.schema.fields])


# ------------------------------------------------------- 2.1 ownership/opacity
from vatlens.operators import ownership as own_ops  # noqa: E402


def _avg(b):
    return own_ops.own_avg_share(own_ops.own_clean(b.ownership))


def _opacity(b):
    return own_ops.opacity_propagate(_avg(b), b.opacity_seed)


@query("own_profile")
def _q_own_profile(b):
    return own_ops.own_profile(b.ownership)


@query("own_company_totals")
def _q_own_company_totals(b):
    return own_ops.company_totals(own_ops.own_clean(b.ownership))


@query("own_clean")
def _q_own_clean(b):
    return own_ops.own_clean(b.ownership)


@query("own_avg_share")
def _q_own_avg_share(b):
    return _avg(b)


@query("own_weight")
def _q_own_weight(b):
    return own_ops.own_weight(_avg(b))


@query("opacity_level0")
def _q_opacity_level0(b):
    return rounded(own_ops.opacity_level0(_avg(b), b.opacity_seed))


@query("opacity_propagate")
def _q_opacity_propagate(b):
    return rounded(_opacity(b)[0].select("company", "value"))


@query("opacity_first_iter")
def _q_opacity_first_iter(b):
    return _opacity(b)[0].select("company", "iteration")


@query("opacity_filled_mesh")
def _q_opacity_filled_mesh(b):
    return rounded(_opacity(b)[1])


@query("opacity_summary")
def _q_opacity_summary(b):
    return rounded(own_ops.opacity_summary(_opacity(b)[0]), 6)


@query("opacity_quartiles")
def _q_opacity_quartiles(b):
    return rounded(own_ops.opacity_quartiles(_opacity(b)[0]), 6)


# ------------------------------------------------------------- 2.2 kinship
from vatlens.operators import kinship as kin_ops  # noqa: E402


def _expanded(b):
    return kin_ops.owners_expand(own_ops.own_clean(b.ownership), rounds=9)


def _leaves(b):
    return kin_ops.owners_natural(_expanded(b), b.opacity_seed)


def _eligible(b, leaves=None):
    leaves = leaves if leaves is not None else _leaves(b)
    return kin_ops.owners_eligible(leaves, kin_ops.owners_completeness(leaves))


@query("owners_expand")
def _q_owners_expand(b):
    return _expanded(b)


@query("owners_natural")
def _q_owners_natural(b):
    return _leaves(b)


@query("companies_per_person")
def _q_companies_per_person(b):
    return kin_ops.companies_per_person(_leaves(b))


@query("owners_completeness")
def _q_owners_completeness(b):
    return kin_ops.owners_completeness(_leaves(b))


@query("owners_eligible")
def _q_owners_eligible(b):
    return _eligible(b)


@query("partner_pairs")
def _q_partner_pairs(b):
    return kin_ops.partner_pairs(_eligible(b))


@query("kin_edges")
def _q_kin_edges(b):
    return kin_ops.kin_edges(b.kinship)


@query("kin_type_counts")
def _q_kin_type_counts(b):
    return kin_ops.kin_type_counts(b.kinship)


@query("kin_matches")
def _q_kin_matches(b):
    return kin_ops.kin_matches(_eligible(b), kin_ops.kin_edges(b.kinship))


def _kinship_rate(b):
    leaves = _leaves(b)
    comp = kin_ops.owners_completeness(leaves)
    matches = kin_ops.kin_matches(kin_ops.owners_eligible(leaves, comp),
                                  kin_ops.kin_edges(b.kinship))
    return kin_ops.kinship_rate(comp, matches)


@query("kinship_rate")
def _q_kinship_rate(b):
    return rounded(_kinship_rate(b))


@query("group_coverage")
def _q_group_coverage(b):
    return kin_ops.group_coverage(b.groups, own_ops.own_clean(b.ownership))


# ------------------------------------------------------- 2.3 contamination
from vatlens.operators import contamination as con_ops  # noqa: E402


def _scores(b):
    edges = con_ops.edge_strength(b.strength)
    init = con_ops.contam_init(con_ops.trade_nodes(edges), con_ops.alert_seeds(b.alerts))
    return con_ops.contam_propagate(edges, init, rounds=15)


@query("alert_seeds")
def _q_alert_seeds(b):
    return con_ops.alert_seeds(b.alerts)


@query("alert_profile")
def _q_alert_profile(b):
    return con_ops.alert_profile(b.alerts)


@query("alert_descriptions")
def _q_alert_descriptions(b):
    return con_ops.alert_descriptions(b.alerts)


@query("edge_strength")
def _q_edge_strength(b):
    return rounded(con_ops.edge_strength(b.strength))


@query("trade_nodes")
def _q_trade_nodes(b):
    return con_ops.trade_nodes(con_ops.edge_strength(b.strength))


@query("contam_init")
def _q_contam_init(b):
    edges = con_ops.edge_strength(b.strength)
    return con_ops.contam_init(con_ops.trade_nodes(edges), con_ops.alert_seeds(b.alerts))


@query("contam_propagate")
def _q_contam_propagate(b):
    return rounded(_scores(b))


# ------------------------------------------------------- 2.4 / 2.5 labels
from vatlens.operators import labels as lab_ops  # noqa: E402

SINCE = "2000-06-01"
TODAY = "2001-12-31"


@query("paid_total")
def _q_paid_total(b):
    return lab_ops.paid_total(b.declarations, SINCE)


@query("vat_net")
def _q_vat_net(b):
    return lab_ops.vat_net(b.invoices, SINCE)


@query("latest_region")
def _q_latest_region(b):
    return lab_ops.latest_region(b.businesses, b.units)


@query("docs_issued")
def _q_docs_issued(b):
    return lab_ops.docs_issued(b.invoices)


@query("lifetime_days")
def _q_lifetime_days(b):
    return lab_ops.lifetime_days(b.taxpayers, TODAY)


@query("initial_alert_flag")
def _q_initial_alert_flag(b):
    nodes = con_ops.trade_nodes(con_ops.edge_strength(b.strength))
    return lab_ops.initial_alert_flag(nodes, con_ops.alert_seeds(b.alerts))


def _labels(b):
    return lab_ops.contam_labels(_scores(b), con_ops.alert_seeds(b.alerts), b.declarations,
                                 b.invoices, b.businesses, b.units, b.taxpayers, SINCE, TODAY)


@query("contam_labels")
def _q_contam_labels(b):
    return rounded(_labels(b))


@query("payroll_period")
def _q_payroll_period(b):
    return lab_ops.payroll_period(b.payroll, list(b.PAYROLL_AMOUNTS))


@query("payroll_latest")
def _q_payroll_latest(b):
    return lab_ops.payroll_latest(lab_ops.payroll_period(b.payroll, list(b.PAYROLL_AMOUNTS)))


@query("fee_workers")
def _q_fee_workers(b):
    return lab_ops.fee_workers(b.fees)


@query("fee_latest")
def _q_fee_latest(b):
    return lab_ops.fee_latest(lab_ops.fee_workers(b.fees))


def _workers(b):
    pl = lab_ops.payroll_latest(lab_ops.payroll_period(b.payroll, list(b.PAYROLL_AMOUNTS)))
    return lab_ops.workers_last(lab_ops.fee_latest(lab_ops.fee_workers(b.fees)), pl)


@query("workers_last")
def _q_workers_last(b):
    return _workers(b)


# ------------------------------------------------------- 2.6 credit tracing
import os  # noqa: E402
import uuid  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from vatlens.operators import credit as cr  # noqa: E402
from vatlens.operators import history as hist_ops  # noqa: E402
from vatlens.session import ensure_checkpoint_dir  # noqa: E402

P1 = 200006
PERIODS_TODAY, PERIODS_YEARS, HISTORY_YEARS = "2001-01-15", 1, 2


def _decl1(b, period=P1):
    cur = cr.decl_current(b.declarations, period)
    return cr.decl_adjust_fm01(cur, cr.observations(b.observations, cr.OBS_FM01, period))


def _flagged_edges(b, decl1=None, period=P1):
    """Edges of a period; the sums and the declarations they meet are tables of their own. Who needs the
    declarations too passes that table (``kept``), so that they are made and shuffled once."""
    decl1 = decl1 if decl1 is not None else kept(_decl1(b, period))
    return cr.trade_edges(kept(cr.trade_sums(cr.ledger_docs(b.ledger, period))), decl1, summed=True)


def _edges(b, decl1=None, period=P1):
    return cr.trade_edges_clamped(_flagged_edges(b, decl1, period))


def _trace(b, period=P1, hops=5):
    """One period, on top of what the periods before it left in the history."""
    return cr.trace_period(b.declarations, b.observations, b.ledger, b.authorisations, b.alerts, period,
                           _history_before(b, period), hops=hops)


def _scratch(b, name):
    root = ensure_checkpoint_dir(b.spark)
    return os.path.join(root, f"vatlens-{name}-{uuid.uuid4().hex}")


def _ledger_periods(b, years=PERIODS_YEARS):
    wanted = cr.periods(b.spark, PERIODS_TODAY, years)
    return b.ledger.select("period").distinct().join(wanted, "period", "left_semi")


_TRACED: dict[tuple, tuple[str, str, str, int | None]] = {}


def _history(b, until=None):
    """Folders of history, carried history and snapshot after tracing the periods of the ledger in order, up to
    ``until`` (all without it), and the last period; written once per application and state of the inputs."""
    key = b.key()
    if (key, until) not in _TRACED:
        months = [r["period"] for r in _ledger_periods(b, HISTORY_YEARS).orderBy("period").collect()
                  if until is None or r["period"] <= until]
        paths = _scratch(b, "history"), _scratch(b, "carried"), _scratch(b, "snapshot")
        together(lambda: b.declarations, lambda: b.observations, lambda: b.authorisations, lambda: b.alerts)
        hist_ops.run_periods(b.spark, b.declarations, b.observations, b.ledger, b.authorisations, b.alerts,
                             months, *paths[:2], snapshot_path=paths[2])
        _TRACED[key, until] = (*paths, months[-1] if months else None)
    return _TRACED[key, until]


def _history_before(b, period=P1):
    """The history that serves ``period``: the one of all periods if it is there (a period depends on earlier ones
    only), else one that ends before it. None when the ledger begins with ``period``."""
    until = None if (b.key(), None) in _TRACED else cr.prior_period_int(period)
    return hist_ops.read_history(b.spark, _history(b, until)[0])


@query("periods")
def _q_periods(b):
    return _ledger_periods(b)


@query("prior_period")
def _q_prior_period(b):
    from vatlens.functions.expr import prior_period
    return b.declarations.select("period").distinct().select("period", prior_period("period").alias("prior"))


@query("decl_latest")
def _q_decl_latest(b):
    return cr.decl_latest(b.declarations, P1)


@query("decl_prior")
def _q_decl_prior(b):
    return cr.decl_prior(b.declarations, cr.prior_period_int(P1))


@query("decl_current")
def _q_decl_current(b):
    return cr.decl_current(b.declarations, P1)


@query("observations")
def _q_observations(b):
    return (cr.observations(b.observations, cr.OBS_FM01, P1).withColumn("code", F.lit("FM01"))
            .unionByName(cr.observations(b.observations, cr.OBS_W08, P1).withColumn("code", F.lit("W08"))))


@query("decl_adjust_fm01")
def _q_decl_adjust_fm01(b):
    return _decl1(b)


@query("carry_in")
def _q_carry_in(b):
    prior = cr.prior_period_int(P1)
    return cr.carry_in(_decl1(b), cr.decl_prior(b.declarations, prior), P1, prior, _history_before(b))


@query("ledger_docs")
def _q_ledger_docs(b):
    return cr.ledger_docs(b.ledger, P1).drop("doc_id", "doc_type")


@query("trade_edges")
def _q_trade_edges(b):
    return _flagged_edges(b)


@query("trade_edges_clamped")
def _q_trade_edges_clamped(b):
    return _edges(b)


@query("decl_or_ledger")
def _q_decl_or_ledger(b):
    d1 = kept(_decl1(b))
    return cr.decl_or_ledger(d1, _edges(b, d1))


@query("nondeclaring_issuers")
def _q_nondeclaring_issuers(b):
    d1 = kept(_decl1(b))
    e = _edges(b, d1)
    return cr.nondeclaring_issuers(e, cr.decl_or_ledger(d1, e))


@query("doc30_issuers")
def _q_doc30_issuers(b):
    return cr.doc30_issuers(b.ledger, b.authorisations, P1)


@query("alerted_issuers")
def _q_alerted_issuers(b):
    return cr.alerted_issuers(_edges(b), b.alerts).select("issuer")


@query("special_credit")
def _q_special_credit(b):
    d1 = kept(_decl1(b))
    return cr.special_credit(cr.decl_or_ledger(d1, _edges(b, d1)), P1)


@query("phantom_edges")
def _q_phantom_edges(b):
    return _trace(b, hops=0).pedges


@query("edge_level0")
def _q_edge_level0(b):
    return cr.edge_level0(_trace(b, hops=0).pedges)


@query("hop1_by_origin")
def _q_hop1_by_origin(b):
    return _trace(b, hops=0).hop1


@query("hop1_result")
def _q_hop1_result(b):
    return rounded(_trace(b, hops=1).hops[0])


@query("hop_next")
def _q_hop_next(b):
    h = _trace(b).hops
    u = h[1]
    for x in h[2:]:
        u = u.unionByName(x)
    return rounded(u)


@query("hops_union")
def _q_hops_union(b):
    return rounded(_trace(b).union)


@query("origin_summary")
def _q_origin_summary(b):
    return rounded(_trace(b).summary)


@query("receivers")
def _q_receivers(b):
    return rounded(_trace(b).recv)


@query("origin_pivot")
def _q_origin_pivot(b):
    return rounded(_trace(b).pivot)


@query("hop_totals")
def _q_hop_totals(b):
    return rounded(_trace(b).totals)


@query("history_upsert")
def _q_history_upsert(b):
    return rounded(b.spark.read.parquet(_history(b)[0]).drop(*hist_ops.STAMP_COLS))


@query("carried_history")
def _q_carried_history(b):
    return rounded(b.spark.read.parquet(_history(b)[1]))


@query("period_extract")
def _q_period_extract(b):
    _, carried, _, last = _history(b)
    return rounded(hist_ops.period_extract(b.spark.read.parquet(carried), last, _scratch(b, "extract")))


@query("snapshot_backup")
def _q_snapshot_backup(b):
    return rounded(b.spark.read.parquet(_history(b)[2]).drop(*hist_ops.STAMP_COLS))


@query("table_profile")
def _q_table_profile(b):
    return hist_ops.table_profile(b.spark.read.parquet(_history(b)[0]).drop(*hist_ops.STAMP_COLS))


@query("export_csv")
def _q_export_csv(b):
    return hist_ops.export_csv_text(b.observations, _scratch(b, "export"))


# ------------------------------------------------------- 2.7 360 and carried
def _t360(b):
    """The loops behind labels, opacity and kinship do not need each other."""
    labels, opacity, kin, workers, worth = together(
        lambda: _labels(b), lambda: _opacity(b)[0], lambda: _kinship_rate(b), lambda: _workers(b),
        lambda: flows.networth(b.networth))
    return flows.taxpayer_360(b.communities, labels, opacity, kin, workers, worth)


@query("taxpayer_360")
def _q_taxpayer_360(b):
    return rounded(_t360(b))


def _t360_carried(b):
    t360, history = together(lambda: _t360(b), lambda: _history(b))
    return flows.latest_carried(t360, b.spark.read.parquet(history[1]))


@query("latest_carried")
def _q_latest_carried(b):
    return rounded(_t360_carried(b))


EXTREME_NORTH, EXTREME_SOUTH = ("AFRICA",), ("EUROPE",)


@query("extreme_regions")
def _q_extreme_regions(b):
    return flows.extreme_regions(b.invoice_points, b.point_regions, EXTREME_NORTH, EXTREME_SOUTH)
