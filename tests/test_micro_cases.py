"""Hand-made micro cases (FIXTURES.md) and invariants, on inline rows."""

import math

from pyspark.sql import functions as F

from vatlens.functions.expr import prior_period, prior_period_int
from vatlens.operators import contamination as con
from vatlens.operators import credit as cr
from vatlens.operators import flows
from vatlens.operators import history as hist
from vatlens.operators import kinship as kin
from vatlens.operators import ownership as own

OWN_SCHEMA = "company long, partner long, capital double, profit double"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_cycle_never_resolves_and_loop_ends(spark):
    mesh = spark.createDataFrame([(1, 2, 50.0, 50.0), (1, 10, 50.0, 50.0), (2, 1, 100.0, 100.0)], OWN_SCHEMA)
    seed = spark.createDataFrame([(10, 0.5)], "id long, value double")
    opacity, filled = own.opacity_propagate(own.own_avg_share(mesh), seed, max_iter=10)
    assert opacity.count() == 0
    assert filled.where("value is null").count() == 2          # 1->2 and 2->1 stay unknown
    expanded = kin.owners_expand(mesh, rounds=9)
    assert expanded.count() > 0                                 # the loop ends after 9 rounds


def test_capital_not_summing_to_100_is_normalised(spark):
    mesh = spark.createDataFrame([(1, 10, 60.0, 60.0), (1, 11, 20.0, 20.0)], OWN_SCHEMA)
    seed = spark.createDataFrame([(10, 1.0), (11, 0.0)], "id long, value double")
    v = own.opacity_level0(own.own_avg_share(mesh), seed).collect()[0]["value"]
    assert math.isclose(v, 0.75)                                # (60*1 + 20*0) / 80


def test_opacity_chain_and_first_iteration(spark):
    # 3 owns 2 owns 1 owns leaf 10: resolves at iterations 0, 1, 2
    mesh = spark.createDataFrame([(1, 10, 100.0, 100.0), (2, 1, 100.0, 100.0), (3, 2, 100.0, 100.0)], OWN_SCHEMA)
    seed = spark.createDataFrame([(10, 0.3)], "id long, value double")
    opacity, _ = own.opacity_propagate(own.own_avg_share(mesh), seed)
    got = rows(opacity, "company", "iteration")
    assert got == [(1, 0), (2, 1), (3, 2)]
    assert all(math.isclose(r["value"], 0.3) for r in opacity.collect())


def test_opacity_chain_of_forty_levels(spark):
    """Each round is driven by the newly resolved companies alone; a value that is NULL resolves nobody."""
    made = [(1, 1000, 100.0)] + [(k, k - 1, 60.0) for k in range(2, 42)] + [(k, 1001, 40.0) for k in range(2, 42)]
    made += [(50, 1000, 0.0), (51, 50, 100.0), (52, 51, 30.0), (60, 41, 50.0), (60, 3, 50.0), (60, 20, 10.0), (61, 62, 100.0), (62, 61, 100.0), (70, 1002, 5.0)]
    shares = spark.createDataFrame([(c, p, x, x) for c, p, x in made], OWN_SCHEMA)
    seed = spark.createDataFrame([(1000, 0.5), (1001, 0.1)], "id long, value double")
    seeds = {1000: 0.5, 1001: 0.1}
    plain, first, it = {}, {}, 0
    while True:                                       # the whole mesh refilled every round
        known = {**plain, **seeds}
        new = {}
        for c in {m[0] for m in made}:
            own_rows = [(p, x) for k, p, x in made if k == c]
            if all(known.get(p) is not None for p, _ in own_rows):
                w = sum(x for _, x in own_rows)
                new[c] = sum(x * known[p] * 0.01 for p, x in own_rows) / w * 100 if w else None
        grown = set(new) - set(first)
        first.update({c: it for c in grown})
        if not grown:
            break
        plain, it = new, it + 1
    trace = own.LoopTrace()
    opacity, filled = own.opacity_propagate(shares.select("company", "partner", "capital"), seed, trace=trace)
    got = {r["company"]: (r["value"], r["iteration"]) for r in opacity.collect()}
    assert {c: i for c, (_, i) in got.items()} == first and max(first.values()) == 41
    assert all(v is None if plain[c] is None else math.isclose(v, plain[c]) for c, (v, _) in got.items())
    assert trace.changed[:3] == [1, 1, 1] and trace.changed[-1] == 0
    known = {**plain, **seeds}
    assert all((r["value"] is None) == (known.get(r["partner"]) is None) for r in filled.collect()) and filled.count() == len(made)


def test_diamond_counts_twice_in_total_once_in_kin(spark):
    # A=1 owns B=2 and C=3; both own person P=10; A also owns person Q=11, kin of P
    mesh = spark.createDataFrame([(1, 2, 50.0, 50.0), (1, 3, 40.0, 40.0), (1, 11, 10.0, 10.0),
                                  (2, 10, 100.0, 100.0), (3, 10, 100.0, 100.0)], OWN_SCHEMA)
    natural = spark.createDataFrame([(10,), (11,)], "id long")
    leaves = kin.owners_natural(kin.owners_expand(mesh), natural)
    comp = kin.owners_completeness(leaves)
    a = comp.where("company = 1").collect()[0]
    assert a["total"] == 3 and a["matched"] == 3                # P twice (two paths) + Q
    edges = kin.kin_edges(spark.createDataFrame([(10, 11, "SIBLING"), (10, 10, "SELF")],
                                                "id long, relative long, relation string"))
    rate = kin.kinship_rate(comp, kin.kin_matches(kin.owners_eligible(leaves, comp), edges))
    r = rate.where("company = 1").collect()[0]
    assert r["kin_owners"] == 2                                 # distinct owners with a kin co-owner
    assert math.isclose(r["kinship_rate"], 2 / 3 * 100)
    pairs = kin.partner_pairs(kin.owners_eligible(leaves, comp)).where("company = 1").collect()[0]
    assert pairs["n_pairs"] == 3 * 3 - (2 * 2 + 1)             # ordered pairs of different owners


def test_edge_strength_fi_equal_one(spark):
    s = spark.createDataFrame([(1, 100, 1.0), (2, 100, 0.5), (3, 200, 1.0), (4, 300, 0.0)],
                              "issuer long, receiver long, fi double")
    e = {(r["issuer"], r["receiver"]): r for r in con.edge_strength(s).collect()}
    assert math.isclose(e[(1, 100)]["f0"], 0.5)                # the Fi = 1 factor is skipped
    assert e[(3, 200)]["f0"] == 0.0                             # all factors skipped -> 0
    assert (4, 300) not in e                                    # Fi <= 0 dropped
    assert math.isclose(e[(1, 100)]["f"], round(0.5 * 1.0, 4) / 1.5)


def test_propagation_keeps_sources_and_never_decreases(spark):
    s = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.8), (4, 3, 0.3)], "issuer long, receiver long, fi double")
    edges = con.edge_strength(s)
    seeds = spark.createDataFrame([(1, 1), (4, 1)], "id long, score int")
    init = con.contam_init(con.trade_nodes(edges), seeds)
    out = {r["id"]: r["score"] for r in con.contam_propagate(edges, init, rounds=15).collect()}
    before = {r["id"]: r["score"] for r in init.collect()}
    assert out[1] == 1.0 and out[4] == 1.0                      # no incoming edges: score kept
    assert all(out[k] >= before[k] for k in out)
    assert out[2] > 0 and out[3] > 0


def test_prior_period_wraps_january(spark):
    assert prior_period_int(200001) == 199912 and prior_period_int(200007) == 200006
    df = spark.createDataFrame([(200001,), (202312,)], "p int").select(prior_period("p").alias("q"))
    assert rows(df, "q") == [(199912,), (202311,)]


def test_hop_totals_leave_special_credit_out(spark):
    cols = {"period": 200006, "receiver": 1, "f29_neto_reci": 10.0, "c_537": 1.0}
    for sfx in cr.PIVOT_ORDER:
        for m in cr.PIVOT_MEASURES:
            cols[f"{m}_{sfx}"] = None
    cols["iva_neto_cdo_a1_al"] = 2.0
    cols["iva_neto_cdo_a1_ce"] = 5.0
    cols["prop_neto_cdo_a2_nd"] = 0.25
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(
        f"{k} {'int' if k in ('period', 'receiver') else 'double'}" for k in cols))
    t = cr.hop_totals(df).collect()[0]
    assert t["iva_neto_cdo_a1_an"] == 2.0 and t["total_cont_an"] == 2.0
    assert t["prop_total_cont_an"] == 0.25


def test_summary_caps_and_null_proportion_for_zero_net(spark):
    schema = ("period int, receiver long, f29_fact_reci double, f29_nc_reci double, f29_neto_reci double, "
              "iva_fact_cdo double, iva_nc_cdo double, iva_neto_cdo double, prop_fact_cdo double, "
              "prop_nc_cdo double, prop_neto_cdo double, hop int, c_537 double, origin int")
    hops = spark.createDataFrame([
        (200006, 1, 5.0, 0.0, 10.0, 1.0, 0.0, 8.0, 0.1, 0.0, 0.8, 1, 1.0, 1),
        (200006, 1, 5.0, 0.0, 10.0, 1.0, 0.0, 7.0, 0.1, 0.0, 0.7, 2, 1.0, 1),
        (200006, 2, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1, 1.0, 2)], schema)
    decl1 = spark.createDataFrame([(1, 200006), (2, 200006)], "id long, period int")
    s = {r["receiver"]: r for r in cr.origin_summary(hops, decl1).collect()}
    assert s[1]["total_cont"] == 15.0 and s[1]["prop_total_cont"] == 1.0   # above the declared net -> 1
    assert s[1]["qty_arco"] == 2
    assert s[2]["prop_total_cont"] is None                                 # declared net 0 -> NULL


def test_upsert_same_period_twice_is_idempotent(spark, scratch_dir):
    path = scratch_dir + "/h"
    a = spark.createDataFrame([(200006, 1, 1.0), (200006, 2, 2.0)], "period int, receiver long, v double")
    b = spark.createDataFrame([(200007, 1, 3.0)], "period int, receiver long, v double")
    hist.history_upsert(a, path)
    hist.history_upsert(b, path)
    hist.history_upsert(a, path)
    got = spark.read.parquet(path).drop(*hist.STAMP_COLS)
    assert rows(got, "period", "receiver", "v") == [(200006, 1, 1.0), (200006, 2, 2.0), (200007, 1, 3.0)]


def test_latest_carried_keeps_ties(spark):
    t360 = spark.createDataFrame([(1,), (2,)], "id long")
    carried = spark.createDataFrame([(200006, 1, 1.0), (200007, 1, 2.0), (200007, 1, 3.0)],
                                    "period int, receiver long, carried_cont double")
    out = flows.latest_carried(t360, carried)
    assert rows(out, "id", "last_carried_period", "carried_cont") == [
        (1, 200007, 2.0), (1, 200007, 3.0), (2, None, None)]


def test_community_with_intra_flow_only(spark):
    arcs = spark.createDataFrame([(1, 2, 10.0), (2, 1, 5.0)], "issuer long, receiver long, vat double")
    com = spark.createDataFrame([(1, 7), (2, 7)], "id long, community int")
    tagged = flows.arcs_tagged(arcs, com)
    r = flows.community_ratios(flows.community_flow(tagged)).collect()[0]
    assert r["issued_intra"] == 15.0 and r["issued_extra"] is None
    assert r["pct_issued_extra"] is None and r["rate_issued_extra_intra"] is None


def test_intra_flows_balance(spark):
    arcs = spark.createDataFrame([(1, 2, 10.0), (2, 3, 5.0), (3, 1, 7.0), (1, 4, 1.0)],
                                 "issuer long, receiver long, vat double")
    com = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None)], "id long, community int")
    cf = flows.community_flow(flows.arcs_tagged(arcs, com))
    s = cf.agg(F.sum("issued_intra").alias("i"), F.sum("received_intra").alias("r")).collect()[0]
    assert s["i"] == s["r"]


def test_path_counts_of_dense_cross_holdings_stay_exact(spark):
    n = 90                                                      # 89^10 paths a company: beyond a long
    firms = spark.range(n)
    mesh = firms.select(F.col("id").alias("company")).join(firms.select(F.col("id").alias("partner"))) \
        .where("company <> partner").selectExpr("company", "partner", "1.0D AS capital", "1.0D AS profit")
    out = kin.owners_expand(mesh, rounds=9)
    per = out.groupBy("company").agg(F.sum("paths").alias("t"), F.min("is_company").alias("left")).collect()
    assert len(per) == n and all(int(r["t"]) == (n - 1) ** 10 and r["left"] == 1 for r in per)


def test_snapshot_takes_only_the_named_partitions(spark, tmp_path):
    path, copy = str(tmp_path / "h"), str(tmp_path / "s")
    hist.snapshot_backup(spark, path, copy, [1])                # nothing to copy yet
    hist.history_upsert(spark.createDataFrame([(1, 10), (2, 20)], "period int, v int"), path, stamp=False)
    hist.snapshot_backup(spark, path, copy, [1])
    hist.snapshot_backup(spark, path, copy, [2, 3])
    assert rows(spark.read.parquet(copy), "period", "v") == [(1, 10), (2, 20)]


def test_csv_reads_back_what_was_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, None), (2, None, "x, \"y\"")], "k int, v double, t string")
    assert rows(hist.as_csv(df, str(tmp_path / "c")), "k", "v", "t") == [(1, 0.1, None), (2, None, 'x, "y"')]
