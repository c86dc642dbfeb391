"""2.6 history: idempotent per-period upsert, snapshot, extract, profile, and
the multi-period driver: one pass over all periods for what needs no earlier period, then a loop in
which each period's carry-in reads the history written by the period before.

Histories are parquet tables partitioned by period. An upsert of period P
writes only partition P with dynamic partition overwrite, so it drops the
period's old rows and appends the new ones in one job, and re-running a period
is idempotent. (Where a store has no atomic rename the replacement is not
atomic; the snapshot holds the partition until then.)
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vatlens.operators import credit as cr
from vatlens.plans.iterate import Beside, remove, shuffles_removed, together
from vatlens.sources.tables import dates_as_text, read_csv, table_exists, write_csv

STAMP_COLS = ("created", "user")


def history_upsert(new_rows: DataFrame, path: str, period_col: str = "period",
                   stamp: bool = True) -> None:
    """Replace the partitions of the periods present in ``new_rows`` (others untouched)."""
    df = new_rows
    if stamp:
        df = df.withColumn("created", F.current_timestamp()).withColumn("user", F.current_user())
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(period_col).parquet(path))


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if table_exists(spark, path) else None


def snapshot_backup(spark: SparkSession, path: str, snapshot_path: str, periods: list[int]) -> None:
    """Copy the partitions of ``periods`` into the snapshot before the history changes
    (no-op when there is no history yet); the snapshot's other partitions stay."""
    h = read_history(spark, path)
    if h is not None:
        history_upsert(h.where(F.col("period").isin(periods)), snapshot_path, stamp=False)


EXTRACT_COLS = (["period", "receiver", "f29_neto_reci", "period_ant", "f29_77_ant", "prop_total_cont_an_ant",
                 "carried_cont", "c_504"]
                + [f"{m}_a{k}_rem" for k in range(1, 6) for m in ("iva_neto_cdo", "prop_neto_cdo")]
                + ["total_cont_rem", "prop_total_cont_rem"])


def as_csv(df: DataFrame, path: str | None) -> DataFrame:
    """``df`` written as CSV and read back with its own schema; ``df`` itself without a path."""
    if not path:
        return df
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def period_extract(carried: DataFrame, period: int, path: str | None = None) -> DataFrame:
    """Carried-credit columns of one period; what the CSV file holds when ``path`` is given."""
    return as_csv(carried.where(F.col("period") == period).select(*EXTRACT_COLS), path)


def table_profile(df: DataFrame, period_col: str = "period") -> DataFrame:
    """Distinct periods (newest first) with the row count of each, the total rows and the column count."""
    n_cols = len(df.columns)
    per = df.groupBy(period_col).agg(F.count(F.lit(1)).alias("rows_in_period"))
    # one row per period: the window runs over the (small) aggregated table only
    total = F.sum("rows_in_period").over(Window.partitionBy())
    return (per.select(period_col, "rows_in_period", total.alias("rows"), F.lit(n_cols).alias("columns"))
            .orderBy(F.col(period_col).desc()))


def export_csv_text(df: DataFrame, path: str | None = None) -> DataFrame:
    """Date/time columns as ``yyyy-MM-dd HH:mm:ss`` text; what the CSV file holds when ``path`` is given."""
    return as_csv(dates_as_text(df), path)


def run_periods(spark: SparkSession, decl: DataFrame, obs: DataFrame, ledger: DataFrame,
                auth: DataFrame, alerts: DataFrame, periods: list[int], history_path: str,
                carried_path: str, phantom_origins: bool = True,
                snapshot_path: str | None = None) -> None:
    """Process periods in order; each one reads the history left by the previous one (the first
    starts cold). What needs no earlier period is computed for all of them at once (``credit.ground``);
    a period's own work is the carried credit and the hops it enters. Before a period is written, the snapshot
    takes the partition that was written last and the one about to be replaced, so that it always
    holds the history as it was; it does so while the period is traced. The carried history of a period is
    written while the next ones are traced."""
    with shuffles_removed(spark):
        g, side = cr.ground(decl, obs, ledger, auth, alerts, phantom_origins, periods), Beside()
        before: list[int] = []
        carried: list[Future] = []
        try:
            for p in periods:
                def backup():
                    if snapshot_path:
                        snapshot_backup(spark, history_path, snapshot_path, [*before, p])
                (totals, carry, hops), _ = together(
                    lambda: cr.trace_carried(g, p, read_history(spark, history_path), phantom_origins), backup)
                history_upsert(totals, history_path)
                before = [p]
                remove(spark, hops[1:])
                carried.append(side.start(lambda p=p, carry=carry, hops=hops: carry_forward(g, p, carry, history_path, carried_path, hops[:1])))
            for done in carried:
                done.result()
        finally:
            side.end()
            g.release()


def carry_forward(g: cr.Ground, period: int, carry: DataFrame, history_path: str, carried_path: str, folders: list[str]) -> None:
    """The carried history of one period, from the history written for it; ``folders`` hold its carry."""
    spark = carry.sparkSession
    history = read_history(spark, history_path)
    if history is not None:                           # else no period had rows so far
        done = history.where(F.col("period") == period).drop(*STAMP_COLS)
        history_upsert(cr.carried_history_rows(done, carry, g.of("decl1", period)), carried_path, stamp=False)
    remove(spark, folders)
