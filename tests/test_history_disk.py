"""What the tracing of all periods leaves behind: results only, and shuffle files that go with their write."""

import os
from decimal import Decimal
from threading import Event

from pyspark.sql import functions as F

from vatlens.operators import credit as cr
from vatlens.operators import history as hist
from vatlens.session import ensure_checkpoint_dir
from vatlens.sources.bindings import Bindings

MONTHS = [200011, 200012, 200101]


def _tables(spark):
    codes = Bindings.DECL_CODES
    decl = [(i, i * 100 + p % 100, p, 1, *[Decimal(40 + i) if c in ("c_504", "c_520", "c_528", "c_537", "c_77") else Decimal(1) for c in codes])
            for i in range(1, 9) if i != 3 for p in MONTHS]
    ledger = [(i * 1000 + j * 10 + p % 10, p, 30 if i == 3 else 33, i, j, 1, "COMPRA", Decimal(i + j)) for i in range(1, 6) for j in range(2, 9) if i != j for p in MONTHS]
    return (spark.createDataFrame(decl, "id long, folio long, period int, validity int, " + ", ".join(f"{c} decimal(18,2)" for c in codes)),
            spark.createDataFrame([(2, p, c, Decimal(5), None, "V") for p in MONTHS for c in ("FM01", "W08")],
                                  "id long, period int, code string, amount decimal(18,2), end_date timestamp, status string"),
            spark.createDataFrame(ledger, "doc_id long, period int, doc_type int, issuer long, receiver long, tx_type int, operation string, vat decimal(18,2)"),
            spark.createDataFrame([(1, "POFE", None)], "id long, attribute string, end_date timestamp"),
            spark.createDataFrame([(2, "4111", None, None)], "id long, code string, deactivated_by string, unblock_folio long"))


def _scratch(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


def test_tracing_leaves_no_scratch_tables(spark, tmp_path):
    tables, before = _tables(spark), _scratch(spark)
    paths = [str(tmp_path / x) for x in ("history", "carried", "snapshot")]
    hist.run_periods(spark, *tables, MONTHS, *paths[:2], snapshot_path=paths[2])
    left = _scratch(spark) - before
    assert len([x for x in left if x.startswith("vatlens-")]) <= 1          # the hot issuers, a handful of rows
    # the carried history is that of the periods read at once
    history, carried = spark.read.parquet(paths[0]), spark.read.parquet(paths[1])
    assert {r[0] for r in carried.select("period").distinct().collect()} == set(MONTHS)
    assert carried.count() == history.count() > 0 and carried.where("carried_cont > 0").count() > 0
    assert {r[0] for r in spark.read.parquet(paths[2]).select("period").distinct().collect()} == set(MONTHS[:-1])
    again = carried.where(F.col("period") == MONTHS[1]).select("receiver", "period_ant").distinct().collect()
    assert again and {r["period_ant"] for r in again} <= {MONTHS[0], None}


def test_the_carried_history_is_written_beside_the_next_period(spark, monkeypatch):
    """A period's carried history waits here until the next period is traced: one after the other would never end."""
    traced, wrote = Event(), []
    monkeypatch.setattr(hist.cr, "ground", lambda *a: type("G", (), {"release": lambda self: None})())
    monkeypatch.setattr(hist.cr, "trace_carried", lambda g, p, *a: (traced.set() if p == MONTHS[1] else None, ("totals", "carry", ["c"]))[1])
    monkeypatch.setattr(hist, "history_upsert", lambda *a, **k: None)
    monkeypatch.setattr(hist, "read_history", lambda *a: None)
    monkeypatch.setattr(hist, "carry_forward", lambda g, p, *a: (traced.wait(60), wrote.append((p, traced.is_set()))))
    hist.run_periods(spark, *[None] * 5, MONTHS[:2], "h", "c")
    assert wrote == [(MONTHS[0], True), (MONTHS[1], True)]


def test_few_edges_still_take_every_core():
    assert [cr.buckets_of(n, 8) for n in (0, 9_999, 35_000, 200_000, 5_000_000)] == [1, 1, 4, 9, 51]
