"""Credit tracing prepares the periods it traces, shuffles the hops of a receiver once, and makes its declarations once."""

from decimal import Decimal

import pytest

from vatlens.operators import credit as cr
from vatlens.plans import registry as reg
from vatlens.sources.bindings import Bindings

MONTHS = (200004, 200005, 200006, 200007)


@pytest.fixture()
def tables(spark):
    codes = Bindings.DECL_CODES
    decl = [(i, i * 100 + p % 100, p, 1, *[Decimal(40 + i) if c in ("c_504", "c_520", "c_528", "c_537", "c_77") else Decimal(1) for c in codes])
            for i in range(1, 9) if i != 3 for p in MONTHS]
    ledger = [(i * 1000 + j * 10 + p % 10, p, 30 if i == 3 else 33, i, j, 1, "COMPRA", Decimal(i + j)) for i in range(1, 6) for j in range(2, 9) if i != j for p in MONTHS]
    return dict(
        decl=spark.createDataFrame(decl, "id long, folio long, period int, validity int, " + ", ".join(f"{c} decimal(18,2)" for c in codes)),
        obs=spark.createDataFrame([(i, p, c, Decimal(5), None, "V") for i in (2, 4) for p in MONTHS for c in ("FM01", "W08")],
                                  "id long, period int, code string, amount decimal(18,2), end_date timestamp, status string"),
        ledger=spark.createDataFrame(ledger, "doc_id long, period int, doc_type int, issuer long, receiver long, tx_type int, operation string, vat decimal(18,2)"),
        auth=spark.createDataFrame([(1, "POFE", None)], "id long, attribute string, end_date timestamp"),
        alerts=spark.createDataFrame([(2, "4111", None, None)], "id long, code string, deactivated_by string, unblock_folio long"))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_ground_prepares_the_periods_traced(spark, tables):
    whole, some = cr.ground(**tables), cr.ground(**tables, periods=[200005, 200006])
    for name in ("decl1", "inputs", "hop_edges", "hop1", "seeds"):
        assert {r[0] for r in getattr(whole, name).select("period").distinct().collect()} >= set(MONTHS)
    for name in ("decl1", "hop_edges", "hop1", "seeds", "declared", "phantom"):
        assert {r[0] for r in getattr(some, name).select("period").distinct().collect()} == {200005, 200006}
    history = spark.createDataFrame([(200004, i, 5.0, 0.5) for i in range(1, 9)], "period int, receiver long, total_cont_an double, prop_total_cont_an double")
    for p, h in ((200005, history), (200006, None)):
        want, got = [cr.trace_carried(g, p, h) for g in (whole, some)]
        assert _rows(got[0]) == _rows(want[0]) and _rows(got[1]) == _rows(want[1]) and want[0].count()
    prior = [r["f29_77_ant"] for r in some.of("inputs", 200005).collect()]
    assert prior and None not in prior                # from the declarations of 200004


def test_hops_of_a_receiver_are_shuffled_once(spark, tables):
    t = cr.trace_period(**tables, period=200006)
    pivot = cr.origin_pivot(cr.origin_summary(t.union, t.decl1))
    plan = pivot._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and pivot.count()


@pytest.mark.parametrize("query", ["decl_or_ledger", "special_credit", "nondeclaring_issuers"])
def test_declarations_are_made_once(spark, tables, query):
    class B:
        declarations, observations, ledger = tables["decl"], tables["obs"], tables["ledger"]
    B.spark = spark
    out = getattr(reg, "_q_" + query)(B)
    assert "max_by" not in out._jdf.queryExecution().executedPlan().toString() and out.count()
