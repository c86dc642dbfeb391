"""Operator 11, sharding by a minimax contiguous partition of atomic groups.

Rows of equal text are one group (NULL counts as the empty text), so copies never part. Groups
stand in the order of their smallest doc_id (a group with NULL ids alone first; ties by digest).
A document's size is the UTF-8 bytes of its text plus 1. The groups are cut into ``shards``
stretches so that the largest has the least possible size:

1. Group sizes, combined on the map side, are range-partitioned in order; running sums within the
   partitions plus the partitions' offsets give every group's end in the whole order.
2. Binary search for the smallest capacity whose greedy check (each shard ends at the last group
   end within the capacity) reaches the last group. The driver holds no list of groups: it holds
   the ends at the borders of some 65,536 cells. A check runs twice, once with the known ends
   alone and once as if every hidden place held an end; capacities on which both agree are
   settled. The cells in which the cuts can still lie are counted anew, finer by a factor
   of thousands each round, until both checks agree on one capacity. So the result is exact for any number
   of groups with three or four passes over their table.
3. Cuts: a shard ends at the first group end that gives it its share of what is left, not beyond the
   capacity, and not before the point from which the rest fits into the shards left. So no shard
   passes the smallest capacity, and a group larger than its share leaves no others empty.

Slots number a shard's rows without gaps in the order (group, doc_id); they come from counts per
range partition, so no shard is one task's work. A group is split over tasks like any other rows.

Repeated rows are rows of their own. A NULL text has size 1 and crc32 0. An empty table
gives an empty result. With fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vatlens.llm.common import materialise

SHARDS = 8
#: Cells that a search round counts at most (more shards need 4 * shards each).
CELLS = 65_536


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """(_row, doc_id, size, text_crc32, _digest) and ``keep`` as _k0, _k1, .., as a table in the shared folder."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: names[i] for i, c in reversed(list(enumerate(docs.columns)))}
    text = F.coalesce(F.col(at["text"]), F.lit(""))
    return materialise(docs.toDF(*names).select(
        F.monotonically_increasing_id().alias("_row"), F.col(at["doc_id"]).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("_digest"), *[F.col(at[c]).alias(f"_k{i}") for i, c in enumerate(keep)]), "sized")


def numbered(df: DataFrame, order: list[str], step: str, by: str | None, name: str) -> DataFrame:
    """``df`` in the order of ``order`` with _part (its range partition) and _upto: the running sum of ``step``
    in the partition (and in the value of ``by``, which grows with the order), as a table."""
    kept = df.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["_part int", "_upto long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.asarray(batch.column(step)).astype(np.int64)
            upto = np.cumsum(size)
            if by is None:
                upto += total
            else:
                key = np.asarray(batch.column(by))
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                before = upto[first] - size[first]
                before[0] = -total if key[0] == last else 0
                upto = upto - np.repeat(before, np.diff(np.append(first, len(key))))
                last = key[-1]
            total = int(upto[-1])
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("_part"), pa.array(upto)], names=[*kept, "_part", "_upto"])

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    return materialise(ordered.mapInArrow(run, schema), name)


def offsets(spark: SparkSession, sums: list[tuple[int, int, int]]) -> DataFrame:
    """(_part, _by, _base): for each value of _by, the sums of earlier partitions. ``sums`` has (part, by, sum)."""
    base, out = {}, []
    for part, by, total in sorted(sums):
        out.append((part, by, base.get(by, 0)))
        base[by] = base.get(by, 0) + total
    return F.broadcast(spark.createDataFrame(out, "_part int, _by int, _base long"))


def group_ends(rows: DataFrame) -> DataFrame:
    """(_digest, end): the groups in order with the sum of all sizes up to each, as a table sorted by ``end``."""
    groups = rows.groupBy("_digest").agg(F.min("doc_id").alias("_first"), F.sum("size").alias("_size"))
    held = numbered(groups, ["_first", "_digest"], "_size", None, "groups")
    sums = held.groupBy("_part").agg(F.max("_upto")).collect()                  # a row each range partition
    base = offsets(rows.sparkSession, [(p, 0, total) for p, total in sums])
    return materialise(held.join(base, "_part").select("_digest", (F.col("_upto") + F.col("_base")).alias("end")), "ends")


class Ends:
    """What the driver knows of the sorted group ends: ``known`` ones, and for the gap behind each whether
    it may hide others."""

    def __init__(self, table: DataFrame, total: int, cells: int):
        self.table, self.total, self.cells = table, total, cells
        self.known, self.hidden = np.array([0, total], np.int64), np.array([True, False])

    def gap(self, x: int) -> int:
        return int(np.searchsorted(self.known, x, "right")) - 1

    def refine(self, spans: list[tuple[int, int]]) -> None:
        """Learn the first and last end of each of ``cells`` cells of each span (low, high]."""
        merged: list[list[int]] = []
        for low, high in sorted(spans):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        cell, inside = F.lit(None).cast("long"), F.lit(False)
        for k, (low, high) in enumerate(merged):
            width = -(-(high - low) // self.cells)
            here = (F.col("end") > low) & (F.col("end") <= high)
            inside = inside | here
            cell = F.when(here, F.lit(k * self.cells) + F.floor((F.col("end") - low - 1) / width)).otherwise(cell)
        got = self.table.where(inside).groupBy(cell.alias("cell")).agg(
            F.min("end").alias("first"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n")).toPandas()
        for low, high in merged:
            self.hidden[(self.known >= low) & (self.known < high)] = False
        ends = np.concatenate([self.known, got["first"].to_numpy(np.int64), got["last"].to_numpy(np.int64)])
        closed = np.concatenate([self.hidden, got["n"].to_numpy() > 2, np.zeros(len(got), bool)])
        self.known, of = np.unique(ends, return_inverse=True)
        self.hidden = np.zeros(len(self.known), bool)
        np.logical_or.at(self.hidden, of, closed)
        # a cell with more than two ends hides some in every gap between its first and last
        for first, last in got.loc[got["n"] > 2, ["first", "last"]].to_numpy(np.int64):
            self.hidden[np.searchsorted(self.known, first):np.searchsorted(self.known, last)] = True

    def path(self, capacity: int, steps: int, hopeful: bool) -> list[int]:
        """Ends of the greedy shards; ``hopeful``: as if every hidden place were an end."""
        out = [0]
        for _ in range(steps):
            to = min(out[-1] + capacity, self.total)
            i = self.gap(to)
            out.append(to if hopeful and self.hidden[i] else int(self.known[i]))
        return out

    def least_capacity(self, steps: int) -> int:
        low = -(-self.total // steps)
        while True:
            found = []
            for hopeful in (True, False):       # the least capacity not refuted; the least that surely holds
                a, b = low, self.total
                while a < b:
                    mid = (a + b) // 2
                    a, b = (a, mid) if self.path(mid, steps, hopeful)[-1] >= self.total else (mid + 1, b)
                found.append(a)
            low, high = found
            if low == high:
                return low
            spans = []
            for p, q in zip(self.path(low, steps, False), self.path(high, steps, True)):
                a, b = self.gap(min(p + low, self.total)), self.gap(min(q + high, self.total))
                gaps = np.flatnonzero(self.hidden[a:b + 1]) + a
                if len(gaps):
                    spans.append((int(self.known[gaps[0]]), int(self.known[gaps[-1] + 1])))
            self.refine(spans)

    def floor(self, x: int) -> int:
        """The last end up to x, exact."""
        while self.known[i := self.gap(x)] < x and self.hidden[i]:
            self.refine([(int(self.known[i]), int(self.known[i + 1]))])
        return int(self.known[self.gap(x)])

    def ceil(self, x: int) -> int:
        """The first end from x on, exact."""
        at = self.floor(x)
        return at if at >= x else int(self.known[self.gap(x) + 1])

    def cuts(self, steps: int) -> list[int]:
        """The ends of the shards but the last."""
        capacity, least = self.least_capacity(steps), [self.total]
        for _ in range(steps - 1):              # from here on the rest fits into the shards left
            least.append(self.ceil(max(least[-1] - capacity, 0)))
        out = [0]
        for i in range(1, steps):
            at, left = out[-1], steps - i + 1
            share = self.ceil(at - (-(self.total - at) // left))
            out.append(min(self.floor(min(at + capacity, self.total)), max(least[steps - i], share)))
        return out[1:]


def minimax_cuts(ends: DataFrame, shards: int, cells: int = CELLS) -> list[int]:
    total = ends.agg(F.coalesce(F.max("end"), F.lit(0))).first()[0]
    return Ends(ends, total, max(cells // shards, 4 * shards)).cuts(shards) if total else []


def sharded(docs: DataFrame, shards: int = SHARDS, keep: tuple[str, ...] = (), cells: int = CELLS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of ``docs``, and the columns ``keep`` as _k0, _k1, .."""
    rows = sized(docs, *keep)
    ends = group_ends(rows)
    shard = F.lit(0)
    for cut in minimax_cuts(ends, shards, cells):
        shard = shard + F.when(F.col("end") > cut, 1).otherwise(0)
    placed = rows.join(ends, "_digest").select("doc_id", "size", "text_crc32", "_row", "end", shard.cast("int").alias("shard"),
                                               F.lit(1).alias("_one"), *[f"_k{i}" for i in range(len(keep))])
    held = numbered(placed, ["end", "doc_id", "_row"], "_one", "shard", "placed")
    sums = held.groupBy("_part", "shard").agg(F.max("_upto")).collect()         # at most range partitions + shards rows
    base = offsets(docs.sparkSession, [tuple(x) for x in sums]).withColumnRenamed("_by", "shard")
    return held.join(base, ["_part", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_base") + F.col("_upto") - 1).alias("slot"), *[f"_k{i}" for i in range(len(keep))])


def sharding(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``."""
    return sharded(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Whole rows of ``docs`` with shard and slot as Parquet, a folder each shard, its files in slot order."""
    out = sharded(docs, shards, tuple(docs.columns)).toDF(
        *["_id", "_size", "_crc", "_shard", "_slot"], *[f"_k{i}" for i in range(len(docs.columns))])
    clash = {"shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns named like the written ones: {sorted(clash)}")
    out.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("_shard").alias("shard"), F.col("_slot").alias("slot")) \
        .write.partitionBy("shard").parquet(path)


def _greedy(capacity: str, shards: int) -> str:
    """SQL: where ``shards`` greedy shards of ``capacity`` end."""
    at = "0"
    for _ in range(shards):
        at = f"(SELECT max(e) FROM b WHERE e <= {at} + {capacity})"
    return at


def sql(shards: int = SHARDS) -> str:
    """The same rows by plain definitions: bisection over all capacities, every check on all group ends."""
    least, cut = [f"l{shards} AS MATERIALIZED (SELECT total AS x FROM t)"], ["c0 AS MATERIALIZED (SELECT 0::HUGEINT AS x)"]
    for i in range(shards - 1, 0, -1):
        least.append(f"l{i} AS MATERIALIZED (SELECT min(e) AS x FROM b WHERE e >= (SELECT x FROM l{i + 1}) - (SELECT c FROM cap))")
    for i in range(1, shards):
        before, left = f"(SELECT x FROM c{i - 1})", shards - i + 1
        share = f"(SELECT min(e) FROM b WHERE e >= {before} + ((SELECT total FROM t) - {before} + {left - 1}) // {left})"
        far = f"(SELECT max(e) FROM b WHERE e <= {before} + (SELECT c FROM cap))"
        cut.append(f"c{i} AS MATERIALIZED (SELECT least({far}, greatest((SELECT x FROM l{i}), {share})) AS x)")
    above = " + ".join(f"(e > (SELECT x FROM c{i}))::INT" for i in range(1, shards))
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS hex FROM documents),
tab AS MATERIALIZED (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
s AS MATERIALIZED (SELECT doc_id, sha256(text) AS g, length(hex) // 2 + 1 AS size, xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(range(0, length(hex) // 2), lambda i: ('0x' || substr(hex, (2 * i + 1)::BIGINT, 2))::BIGINT)),
  lambda c, y: xor(c // 256, t[(xor(c, y) & 255) + 1]))) AS crc FROM d, tab),
g AS MATERIALIZED (SELECT g, sum(sum(size)) OVER (ORDER BY min(doc_id) NULLS FIRST, g ROWS UNBOUNDED PRECEDING) AS e FROM s GROUP BY g),
b AS MATERIALIZED (SELECT e FROM g UNION ALL SELECT 0),
t AS MATERIALIZED (SELECT max(e) AS total FROM b),
step AS (SELECT 0::HUGEINT AS low, total AS high FROM t UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid + 1 END, CASE WHEN ok THEN mid ELSE high END
  FROM (SELECT low, high, (low + high) // 2 AS mid, {_greedy('(low + high) // 2', shards)} = (SELECT total FROM t) AS ok FROM step WHERE low < high)),
cap AS MATERIALIZED (SELECT min(high) AS c FROM step),
{", ".join(least)}, {", ".join(cut)},
p AS (SELECT doc_id, size, crc, e, {above} AS shard FROM s JOIN g USING (g))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY e, doc_id NULLS FIRST) - 1 AS slot, NULL::INT AS grown_shard FROM p
"""


SQL = sql()
