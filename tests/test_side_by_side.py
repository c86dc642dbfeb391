"""Steps that do not need each other run side by side, and large inputs are dealt to more tasks."""

from threading import Barrier

from pyspark.sql import functions as F

from vatlens.operators import contamination as con
from vatlens.operators import history as hist
from vatlens.plans import iterate, registry as reg
from vatlens.sources import bindings as bd
from vatlens.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"


def _meeting(n, value):
    """A step that ends only when ``n`` of them run at the same time."""
    barrier = Barrier(n, timeout=60)

    def step(*args, **kwargs):
        barrier.wait()
        return value
    return step


def test_history_and_360_are_made_side_by_side(spark, monkeypatch):
    meet = Barrier(2, timeout=60)
    t360 = spark.createDataFrame([(1,), (2,)], "id long")
    monkeypatch.setattr(reg, "_t360", lambda b: (meet.wait(), t360)[1])
    monkeypatch.setattr(reg, "_history", lambda b: (meet.wait(), ("h", "carried", "s", 200012))[1])

    class B:
        class spark:
            class read:
                @staticmethod
                def parquet(path):
                    assert path == "carried"
                    return spark.createDataFrame([(200011, 1, 0.5), (200012, 1, 0.7)], "period int, receiver long, carried_cont double")
    got = {r["id"]: (r["last_carried_period"], r["carried_cont"]) for r in reg._t360_carried(B).collect()}
    assert got == {1: (200012, 0.7), 2: (None, None)}


def test_loops_of_360_are_made_side_by_side(spark, monkeypatch):
    step = _meeting(4, None)
    for name in ("_labels", "_kinship_rate", "_workers"):
        monkeypatch.setattr(reg, name, step)
    monkeypatch.setattr(reg, "_opacity", lambda b: (step(b),))
    monkeypatch.setattr(reg.flows, "networth", lambda n: None)
    monkeypatch.setattr(reg.flows, "taxpayer_360", lambda *a: a)

    class B:
        communities, networth = "c", "n"
    assert reg._t360(B)[0] == "c"


def test_snapshot_is_taken_while_a_period_is_traced(spark, monkeypatch):
    meet, seen = Barrier(2, timeout=60), []
    monkeypatch.setattr(hist.cr, "ground", lambda *a: type("G", (), {"release": lambda self: None, "decl1": None})())
    monkeypatch.setattr(hist.cr, "trace_carried", lambda *a: (meet.wait(), ("totals", "carry", ["c"]))[1])
    monkeypatch.setattr(hist, "snapshot_backup", lambda s, h, p, periods: (seen.append(periods), meet.wait()))
    monkeypatch.setattr(hist, "read_history", lambda *a: None)
    wrote = []

    def upsert(rows, path, **k):
        wrote.append(len(seen))                       # the snapshot of this period is there
        if len(wrote) == 2:
            raise StopIteration
    monkeypatch.setattr(hist, "history_upsert", upsert)
    try:
        hist.run_periods(spark, *[None] * 5, [200001, 200002], "h", "c", snapshot_path="s")
    except StopIteration:
        pass
    assert seen == [[200001], [200001, 200002]] and wrote == [1, 2]


def test_a_table_that_two_steps_need_is_written_once(spark, monkeypatch):
    built, both = [], Barrier(2, timeout=60)
    monkeypatch.setattr(Bindings, "key", lambda self: ("app", "made-up", "state"))
    monkeypatch.setattr(bd, "_MATERIALISED", {})
    b = Bindings(spark, SF)

    def build(x):
        built.append(1)
        return spark.range(3)

    def need():
        both.wait()
        return b.derived("two", build).count()
    assert iterate.together(need, need) == [3, 3] and built == [1]


def test_many_lines_are_dealt_to_more_tasks(spark, monkeypatch):
    b = Bindings(spark, SF, materialise=False)
    few = {c: getattr(b, c).groupBy().agg(F.count(F.lit(1)), F.sum("vat")).first() for c in ("arcs", "ledger")}
    monkeypatch.setattr(bd, "LINES_PER_TASK", 500)
    many = Bindings(spark, SF, materialise=False)
    n = -(-b.raw("lineitem").count() // 500)
    assert n > 4 and many._lines().rdd.getNumPartitions() == n == many.arcs.rdd.getNumPartitions()
    assert few == {c: getattr(many, c).groupBy().agg(F.count(F.lit(1)), F.sum("vat")).first() for c in few}


def test_many_edges_take_more_buckets(spark, monkeypatch):
    edges = con.edge_strength(spark.createDataFrame([(i, j, 0.1 + i / 50) for i in range(8) for j in range(4, 12) if i != j], "issuer long, receiver long, fi double"))
    init = con.contam_init(con.trade_nodes(edges), spark.createDataFrame([(1, 1)], "id long, score int"))
    few = con.contam_propagate(edges, init).collect()
    made, bucketed = [], con.bucketed
    monkeypatch.setattr(iterate, "PARTITION_ROWS", 6)
    monkeypatch.setattr(con, "bucketed", lambda df, keys, n, **k: (made.append(n), bucketed(df, keys, n, **k))[1])
    many = con.contam_propagate(edges, init).collect()
    assert min(made) == -(-edges.count() // 6) > 4
    assert {r["id"]: round(r["score"], 9) for r in few} == {r["id"]: round(r["score"], 9) for r in many} and len(few) == len(many)
