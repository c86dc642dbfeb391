"""Operator 10, exact dedup by a heavy-hitter split. DataFrame and SQL functions only.

A Misra-Gries summary (``approx_top_k``: the frequent-items sketch, whose map
side is bounded by ``tracked`` counters) names the digests that may hold many
rows. Their exact counts and winners are computed with map-side combining (each
task sends at most ``heavy`` rows) and broadcast, so their rows are settled
without a shuffle. All other digests are shuffled in the ordinary way, their groups combined on
the map side; none of them can hold more than 1 / (heavy + 1) of the rows (0.098 %).

Equal: identical after lower-casing A-Z; a NULL text counts as empty. The row with
the largest doc_id stays (NULL is the smallest id). Rows that repeat doc_id and text
are copies of each other too: one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import ascii_lower, drop_rows, materialise, row_key

#: Digests settled by broadcast at most, and counters of the summary.
HEAVY, TRACKED = 1024, 8192


def digests(docs: DataFrame, *more) -> DataFrame:
    """(_row, doc_id, _digest, ...): the digest of each normalised text, as a table in the shared folder."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return materialise(docs.select(F.col("doc_id"), F.sha2(text, 256).alias("_digest"), *more)
                       .withColumn("_row", F.monotonically_increasing_id()), "digests")


def winners(rows: DataFrame) -> DataFrame:
    """(_digest, _win, group_size): the winning row and the size of each group."""
    return rows.groupBy("_digest").agg(F.max(F.struct(*[c for c in ("doc_id", "_row", "_md5") if c in rows.columns])).alias("_win"), F.count(F.lit(1)).alias("group_size"))


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """``winners`` of the frequent digests, exact; at most ``heavy`` rows."""
    named = rows.agg(F.expr(f"approx_top_k(_digest, {heavy}, {tracked})").alias("_top")) \
        .select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias("_digest")).where("_digest is not null")
    return materialise(winners(rows.join(F.broadcast(named), "_digest", "left_semi")).where("group_size > 1"), "heavy")


def resolve(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """``rows`` with (_win, group_size): the winner and the size of each row's group."""
    top = heavy_digests(rows, heavy, tracked)
    settled = rows.join(F.broadcast(top), "_digest")
    rest = rows.join(F.broadcast(top.select("_digest")), "_digest", "left_anti")
    # a table of its own: both join sides are then plain shuffles
    return settled.unionByName(rest.join(materialise(winners(rest), "winners"), "_digest"))


def exact_dedup(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    return resolve(digests(docs), heavy, tracked).select(
        "doc_id", F.col("_win.doc_id").alias("keep_id"), "group_size",
        (F.col("_win._row") == F.col("_row")).alias("kept"), F.col("_digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns kept."""
    rows = resolve(digests(docs, *row_key()[1:]), heavy, tracked).where("_row <> _win._row")
    # a loser of the winner's id and text is equal to it: one of those rows stays
    same = F.col("doc_id").eqNullSafe(F.col("_win.doc_id")) & (F.col("_md5") == F.col("_win._md5"))
    losers = rows.groupBy(F.col("doc_id").alias("_id"), "_md5").agg(F.max(~same).alias("_all"))
    return drop_rows(docs, materialise(losers, "losers"))


SQL = r"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
