"""Operator 13, hard-negative mining by threshold joins in the manner of L2AP.

A component x becomes floor(256 x); a score is the inner product of two such integer vectors. An
anchor's positives are its best ``positives`` other rows of the same label; for each, its negatives are the
best ``negatives`` rows of other labels whose score lies in the window
[low * positive_score, high * positive_score] (percent). Higher scores come first, ties by smaller vec_id
(then by row). Positives and negatives are both windows (from, to, number of rows wanted) of one query
an anchor, and one threshold join answers them:

1. Each block of rows builds an index for a batch of queries: dimensions stand in falling order of their
   mean square, and of a row only the leading ones are indexed, up to where the norm of the rest times the
   largest norm of the queries' rest is below the batch's smallest threshold. That suffix alone
   cannot reach the threshold. Rows lie in falling order of their indexed length, so the posting list of a
   dimension is a stretch from the first row on.
2. Partial scores are accumulated over the lists, some dimensions at a time; a row leaves as soon as
   the partial score plus the product of the remaining norms stays below the thresholds of all queries of
   the batch. Pairs that pass with the norm of the suffix get their exact score from the suffix itself.
3. Thresholds start high and fall until windows fill. A first join of each anchor with one block
   gives its ``wanted`` best scores there: the best one is the first threshold for the join with all
   blocks; windows with too few rows go on with the lowest one; and those that the first block could
   not fill with the window's own lower end. Filled windows leave. A window's threshold never
   changes what is returned: it is filled only when it holds all rows down to the threshold.

Rows with a NULL vec_id or label, a NULL vector, or a component that is NULL or not finite take no part. Vectors of
different lengths are compared as if the shorter had zeros behind. Rows that repeat a vec_id are rows of
their own. An empty table gives an empty result. Scores are exact while every sum of products stays below 2**53;
beyond that they are added up as 64-bit integers, without pruning, and compared as doubles (2**63 and more overflow).

Rows are dealt to blocks by hash, so equal vectors or a hot label do not meet in one task. Each query visits every
block; a task holds one block and streams the queries of its slice. With n rows and a queries the shuffle
moves n * slices + a * n / BLOCK_ROWS vectors, with as many slices as keep MIN_TASKS tasks busy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vatlens.llm.common import materialise

POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Rows of a block, tasks at least, queries of a batch, rows scored at once, dimensions between two prunings.
BLOCK_ROWS, MIN_TASKS, BATCH, TILE, STRIDE = 131_072, 12, 64, 8192, 16
#: Every how many ids one is an anchor, and one is given the next label.
ANCHORS, MOVED, LABELS = 50, 7, 10

WIDTHS = (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63))


def quantised(embeddings: DataFrame, moved: int | None = None) -> DataFrame:
    """(_row, vec_id, label, v array<long>, _peak: its largest size of a component) of the rows that take part, as a table.

    With ``moved`` the label of ids divisible by it is the next one modulo LABELS."""
    names = [f"_c{i}" for i in range(len(embeddings.columns))]
    at = {c: names[i] for i, c in reversed(list(enumerate(embeddings.columns)))}
    v = F.col(at["embedding"]).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = embeddings.toDF(*names).select(F.col(at["vec_id"]).cast("long").alias("vec_id"), F.col(at["label"]).cast("long").alias("label"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~bad)
    d = d.withColumn("v", F.transform("v", lambda x: F.floor(256 * x).cast("long")))
    if moved:
        d = d.withColumn("label", F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")))
    return materialise(d.select(F.monotonically_increasing_id().alias("_row"), "vec_id", "label", "v",
                                F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0)).alias("_peak")), "quantised")


@dataclass
class Shape:
    """What every task knows: rows in all, dimensions and their order, the stored width, whether doubles are exact."""

    rows: int
    size: int
    order: list[int]
    kind: str
    exact: bool


def shape_of(rows: DataFrame) -> Shape:
    n, size, peak = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max("_peak"), F.lit(0))).first()
    # mean squares of the dimensions: one row a dimension
    energy = {r["i"]: r["e"] for r in rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("double") * F.col("x")).alias("e")).collect()}
    order = sorted(range(size), key=lambda i: (-energy.get(i, 0.0), i))
    return Shape(n, size, order, next((k for k, top in WIDTHS if peak < top), "<i8"), size * float(peak) ** 2 < 2.0 ** 53)


def packed(rows: DataFrame, shape: Shape) -> DataFrame:
    """(_row, vec_id, label, v binary): vectors in the order of the dimensions, in the smallest width that holds them."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v")
            lens = np.diff(np.asarray(v.offsets))
            out = np.zeros((batch.num_rows, shape.size), np.int64)
            out[np.repeat(np.arange(len(lens)), lens), np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)] = np.asarray(v.flatten())
            raw = out[:, shape.order].astype(shape.kind)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("vec_id"), batch.column("label"),
                                              pa.array([x.tobytes() for x in raw], pa.binary())], names=["_row", "vec_id", "label", "v"])

    return materialise(rows.select("_row", "vec_id", "label", "v").mapInArrow(pack, "_row long, vec_id long, label long, v binary"), "vectors")


def suffix_norms(x: np.ndarray) -> np.ndarray:
    """[:, k]: the norm of the components from k on."""
    squares = np.zeros((len(x), x.shape[1] + 1))
    np.cumsum((x * x)[:, ::-1], axis=1, out=squares[:, 1:])
    return np.sqrt(squares[:, ::-1])


class Block:
    """The rows of one block, and the threshold search of query batches over them."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray, exact: bool):
        self.exact = exact
        self.row, self.vec_id, self.label, self.x = row, vec_id, label, (x.astype(float) if exact else x.astype(np.int64))
        self.rest = suffix_norms(self.x) if exact else None

    def above(self, q: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, row, score) of all pairs with a score of at least the query's ``least``, some rows at a time."""
        size = q.shape[1]
        if not self.exact:
            for low in range(0, len(self.x), TILE):
                score = q @ self.x[low:low + TILE].T
                a, b = np.nonzero(score >= least[:, None])
                yield a, b + low, score[a, b]
            return
        rest = suffix_norms(q)
        slack = 1e-9 * (1 + rest[:, :1] * self.rest[:, 0].max(initial=0.0)).max(initial=1.0)
        reach = rest.max(axis=0, initial=0.0)
        for low in range(0, len(self.x), TILE):
            # the index: of each row the dimensions in front of the suffix that cannot reach the threshold
            indexed = np.count_nonzero(self.rest[low:low + TILE] * reach >= least.min() - slack, axis=1)
            indexed = np.minimum(indexed, size)
            rows = low + np.argsort(-indexed, kind="stable")
            indexed = indexed[rows - low]
            rows, indexed = rows[indexed > 0], indexed[indexed > 0]
            partial, lists = np.zeros((len(q), len(rows))), self.x[rows]
            for at in range(0, size, STRIDE):
                to = min(at + STRIDE, size)
                posted = int(np.searchsorted(-indexed, -at, "left"))         # rows with an entry from dimension ``at`` on
                if not posted:
                    break
                entry = lists[:posted, at:to] * (np.arange(at, to) < indexed[:posted, None])
                partial[:, :posted] += q[:, at:to] @ entry.T
                done = np.minimum(to, indexed)
                live = ((partial + rest[:, [to]] * self.rest[rows, to] >= least[:, None] - slack) if to <= indexed.min(initial=size) else
                        (partial + rest[:, done] * self.rest[rows, done] >= least[:, None] - slack))
                stay = live.any(axis=0)
                if stay.sum() < 0.8 * len(stay):
                    partial, lists, rows, indexed = partial[:, stay], lists[stay], rows[stay], indexed[stay]
            bound = partial + rest[:, indexed] * self.rest[rows, indexed]
            a, b = np.nonzero(bound >= least[:, None] - slack)
            score = partial[a, b]
            for k in np.unique(indexed[b]):                                  # the suffixes of the candidates
                of = np.flatnonzero(indexed[b] == k)
                if k < size:
                    for cut in range(0, len(of), 65_536):
                        part = of[cut:cut + 65_536]
                        score[part] += np.einsum("ij,ij->i", q[a[part], k:], lists[b[part], k:])
            good = score >= least[a]
            yield a[good], rows[b[good]], np.rint(score[good])


def best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of each query's ``wanted`` best, in order."""
    order = np.lexsort([row, vec_id, -score, query])
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < wanted[q]]


WINDOWS = "array<struct<w: int, least: double, most: double, wanted: int>>"
HITS = "_anchor long, w int, _row long, vec_id long, score long"


def threshold_join(rows: DataFrame, queries: DataFrame, shape: Shape, same: bool, seed: bool = False) -> DataFrame:
    """(_anchor, w, _row, vec_id, score): for every window w of every query the best ``wanted`` rows with a score from
    ``least`` to ``most``, per block. ``queries``: _anchor, label, v, windows. Rows have the query's label (and
    are not itself) if ``same``, else another. ``seed``: the query meets one block only."""
    blocks = -(-shape.rows // BLOCK_ROWS)
    slices = -(-MIN_TASKS // blocks)
    in_block = F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int")
    none = F.lit(None).cast(WINDOWS)
    slice_ = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    held = rows.select(in_block.alias("block"), slice_.alias("slice"), F.lit(0).alias("kind"), "_row", "vec_id", "label", "v", none.alias("windows"))
    by_block = F.pmod(F.xxhash64("_anchor", F.lit(1)), F.lit(blocks)).cast("int")
    asked = queries.withColumn("block", by_block if seed else F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "block", F.pmod(F.xxhash64("_anchor", F.lit(2)), F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("kind"),
        F.col("_anchor").alias("_row"), F.lit(0).cast("long").alias("vec_id"), "label", "v", "windows")
    exact, kind, size = shape.exact, shape.kind, shape.size

    def vectors(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), size)

    def answer(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, label = np.asarray(batch.column("_row")), np.asarray(batch.column("label"))
        windows = batch.column("windows")
        lens = np.diff(np.asarray(windows.offsets))
        flat = windows.flatten()
        w, least, most, wanted = (np.asarray(flat.field(k)).copy() for k in ("w", "least", "most", "wanted"))
        first = np.cumsum(lens) - lens
        q = vectors(batch.column("v")).astype(float if exact else np.int64)
        # thresholds of the queries: the lowest of their windows, raised as windows fill
        own = np.repeat(np.arange(len(anchor)), lens)
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]              # window, row, score
        floor = np.minimum.reduceat(least, first)
        for a, b, score in block.above(q, floor):
            fit = (block.label[b] == label[a]) == same
            if same:
                fit &= block.row[b] != anchor[a]
            a, b, score = a[fit], b[fit], score[fit]
            found = [kept]
            for k in range(int(lens.max(initial=0))):
                at = first[a] + k
                inside = k < lens[a]
                at[~inside] = 0
                inside &= (score >= least[at]) & (score <= most[at])
                found.append([at[inside], b[inside], score[inside]])
            kept = [np.concatenate([f[k] for f in found]) for k in range(3)]
            top = best(kept[0], kept[2], block.vec_id[kept[1]], block.row[kept[1]], wanted)
            kept = [x[top] for x in kept]
            lowest = np.full(len(w), np.inf)
            np.minimum.at(lowest, kept[0], kept[2])
            full = np.bincount(kept[0], minlength=len(w)) >= wanted
            least[full] = np.maximum(least[full], lowest[full])
            floor[:] = np.minimum.reduceat(least, first)
        return pa.RecordBatch.from_arrays([pa.array(anchor[own[kept[0]]]), pa.array(w[kept[0]].astype(np.int32)), pa.array(block.row[kept[1]]),
                                           pa.array(block.vec_id[kept[1]]), pa.array(kept[2].astype(np.int64))],
                                          names=["_anchor", "w", "_row", "vec_id", "score"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("block", "slice", "kind")], axis=1)
            cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(group)]):
                place = (int(group[low, 0]), int(group[low, 1]))
                if place != now:
                    now, parts, block = place, [], None
                part = batch.slice(low, high - low)
                if not group[low, 2]:
                    parts.append((np.asarray(part.column("_row")), np.asarray(part.column("vec_id")), np.asarray(part.column("label")), vectors(part.column("v"))))
                elif parts or block:
                    if block is None:
                        block, parts = Block(*(np.concatenate([p[k] for p in parts]) for k in range(4)), exact), []
                    for cut in range(0, high - low, BATCH):
                        yield answer(block, part.slice(cut, min(BATCH, high - low - cut)))

    met = held.unionByName(asked).repartition(blocks * slices, "block", "slice").sortWithinPartitions("block", "slice", "kind")
    return met.mapInArrow(join, HITS)


def merged(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(_anchor, w, rank, _row, vec_id, score): the best ``wanted`` of each window over all blocks."""
    order = Window.partitionBy("_anchor", "w").orderBy(F.col("score").desc(), "vec_id", "_row")
    return hits.join(windows.select("_anchor", "w", "wanted"), ["_anchor", "w"]).withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= F.col("wanted")).drop("wanted")


def fill(rows: DataFrame, anchors: DataFrame, windows: DataFrame, shape: Shape, same: bool) -> DataFrame:
    """(_anchor, w, rank, _row, vec_id, score) of ``windows`` (_anchor, w, bottom, most, wanted): all of each window's best rows."""
    def asked(w: DataFrame, least: Column) -> DataFrame:
        held = w.groupBy("_anchor").agg(F.sort_array(F.collect_list(F.struct("w", least.cast("double").alias("least"), F.col("most").cast("double").alias("most"),
                                                                             F.col("wanted").cast("int").alias("wanted")))).alias("windows"))
        return anchors.join(held, "_anchor").select("_anchor", "label", "v", "windows")

    # the first block's best scores: thresholds for the others
    first = threshold_join(rows, asked(windows, F.col("bottom")), shape, same, seed=True)
    seeds = first.groupBy("_anchor", "w").agg(F.max("score").alias("_high"), F.min("score").alias("_low"), F.count(F.lit(1)).alias("_n"))
    state = materialise(windows.join(seeds, ["_anchor", "w"], "left").withColumns({
        "_low": F.when(F.col("_n") >= F.col("wanted"), F.col("_low")).otherwise(F.col("bottom")),
        "_high": F.coalesce("_high", "bottom")}).drop("_n"), "thresholds")
    done = None
    for least in ("_high", "_low"):
        top = materialise(merged(threshold_join(rows, asked(state, F.col(least)), shape, same), state), "filled")
        counts = top.groupBy("_anchor", "w").agg(F.count(F.lit(1)).alias("_n"))
        after = state.join(counts, ["_anchor", "w"], "left").withColumn("_full", (F.coalesce("_n", F.lit(0)) >= F.col("wanted")) | (F.col(least) == F.col("_low")))
        after = materialise(after.drop("_n"), "thresholds")
        full = top.join(after.where("_full").select("_anchor", "w"), ["_anchor", "w"], "left_semi")
        done = full if done is None else done.unionByName(full)
        state = after.where("not _full").drop("_full")
        if state.isEmpty():
            break
    return done


def mine(embeddings: DataFrame, every: int = ANCHORS, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, moved: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the rows whose
    vec_id is divisible by ``every``."""
    plain = quantised(embeddings, moved)
    shape = shape_of(plain)
    if not shape.rows:
        return embeddings.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows = packed(plain, shape)
    anchors = rows.where(F.col("vec_id") % every == 0).select(F.col("_row").alias("_anchor"), F.col("vec_id").alias("anchor_id"), "label", "v")
    everything = anchors.select("_anchor", F.lit(0).alias("w"), F.lit(float("-inf")).alias("bottom"), F.lit(float("inf")).alias("most"), F.lit(positives).alias("wanted"))
    found = materialise(fill(rows, anchors, everything, shape, True).select("_anchor", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"),
                                                                            F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score").cast("decimal(38,0)")
    windows = found.withColumns({"bottom": F.ceil(low * score / 100).cast("double"), "most": F.floor(high * score / 100).cast("double"),
                                 "wanted": F.lit(negatives)}).where("bottom <= most")
    best_ = fill(rows, anchors, windows.select("_anchor", "w", "bottom", "most", "wanted"), shape, False)
    return best_.select("_anchor", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(found, ["_anchor", "w"]).join(anchors.select("_anchor", "anchor_id"), "_anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def mined_embeddings(embeddings: DataFrame) -> DataFrame:
    """The registered query: labels of ids divisible by 7 moved on, anchors every 50 ids."""
    return mine(embeddings, moved=MOVED)


SQL = r"""
WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
      FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 3
"""
