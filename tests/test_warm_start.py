"""A single period starts from the history that the periods before it left."""

from pyspark.sql import functions as F

from vatlens.operators import credit as cr
from vatlens.operators import history as hist
from vatlens.plans import registry as reg
from vatlens.plans.iterate import cut
from vatlens.sources.bindings import bind

SF = "/root/testdata/sf0.001"


def test_single_period_carries_credit_of_the_period_before(spark, tmp_path):
    b = bind(spark, SF)
    inputs = (b.declarations, b.observations, b.ledger, b.authorisations, b.alerts)
    path = str(tmp_path / "history")
    hist.run_periods(spark, *inputs, [cr.prior_period_int(reg.P1), reg.P1], path, str(tmp_path / "carried"))
    history = hist.read_history(spark, path)
    got = cr.trace_period(*inputs, reg.P1, history)
    own = got.pedges.where(F.col("node_kind") == cr.PHANTOM["REM"])
    assert own.where("iva_neto > 0").count() > 0
    assert got.hop1.where("origin = 5 and iva_neto_cont > 0").count() > 0
    # what the job of all periods writes for it
    whole = reg.rounded(history.where(F.col("period") == reg.P1).drop(*hist.STAMP_COLS))
    one = reg.rounded(got.totals).select(*whole.columns)
    one = cut(one.select([F.col(f.name).cast(f.dataType) for f in whole.schema.fields]))
    assert one.count() == whole.count() > 0
    assert one.exceptAll(whole).isEmpty() and whole.exceptAll(one).isEmpty()


def test_a_history_that_ends_before_serves_the_single_period(spark, monkeypatch):
    """The full history serves it when it is there; else only the periods before it are traced."""
    b, asked = bind(spark, SF), []
    monkeypatch.setattr(reg, "_TRACED", {})
    monkeypatch.setattr(hist, "run_periods", lambda *a, **k: asked.append(a[6]))
    assert reg._history_before(b) is None                          # nothing was written
    assert asked and max(asked[0]) == cr.prior_period_int(reg.P1)
    reg._history(b)
    assert max(asked[1]) > reg.P1
    reg._history_before(b)
    assert len(asked) == 2


def test_carry_reads_one_partition_of_the_history(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [(p, r, 1.0, 0.5 if r else -0.5) for p in (200004, 200005) for r in range(3)]
    hist.history_upsert(spark.createDataFrame(rows, "period int, receiver long, total_cont_an double, prop_total_cont_an double"), path)
    inputs = spark.createDataFrame([(1, 200006, 0.0, 9.0, 8.0, 1.0, 1)], "receiver long, period int, f29_77_ant double, c_504_orig double, "
                                   "c_504 double, fm01 double, declares int")
    carry = cr.carry_of(inputs, 200006, 200005, hist.read_history(spark, path))
    scan = carry._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in scan and "(period#" in scan and "= 200005)" in scan
    got = {r["receiver"]: (r["prop_total_cont_an_ant"], r["carried_cont"]) for r in carry.collect()}
    assert got == {0: (0.0, 0.0), 1: (0.5, 4.0), 2: (0.5, 0.0)}     # floored; of 504 after FM01; 0 without a declaration
