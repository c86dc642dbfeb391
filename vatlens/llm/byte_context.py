"""Variable-order byte contexts with frozen statistics, shared by operators 1 and 7.

A text is a stream of symbols: its bytes after a fixed folding (letters of ASCII and
Latin-1 lower-cased, digits, white space and other ASCII marks as one symbol each, all
other bytes as they are). Counting takes every (context of ``order`` symbols, symbol)
of every class over all learning texts; contexts seen often enough become nodes, and
shorter ones follow by summing. A node gives every class a full distribution over the
symbols, mixed down its suffixes once, when the model is frozen. Scoring a text is then
two table reads a byte: the deepest node of the last symbols, and its code lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vatlens.llm.common import chunked, discard, materialise, text_bytes

LETTERS, DIGIT, BLANK, MARK, HIGH = 0, 26, 27, 28, 29
#: Symbols of the text folding: 26 letters, digit, blank, mark, 126 bytes from 0x80 to 0xFD.
TEXT_SYMBOLS = HIGH + 126


def text_table() -> np.ndarray:
    """byte -> symbol for running text."""
    t = np.full(256, MARK, np.uint8)
    for i in range(26):
        t[65 + i] = t[97 + i] = LETTERS + i
    t[48:58] = DIGIT
    t[[9, 10, 11, 12, 13, 32]] = BLANK
    t[0x80:0xFE] = HIGH + np.arange(126)
    return t


_TEXT = text_table()


def text_symbols(raw: np.ndarray) -> np.ndarray:
    """Symbols of UTF-8 bytes, capitals of Latin-1 (0xC3 0x80-0x9E) lower-cased."""
    out = _TEXT[raw]
    capital = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[:-1] == 0xC3) & (raw[1:] != 0x97)) + 1
    out[capital] += 0x20
    return out


def url_table() -> tuple[np.ndarray, int]:
    """byte -> symbol for URLs: letters, one digit symbol, each ASCII mark; other bytes as one."""
    t = np.zeros(256, np.uint8)
    n = 1
    for b in range(33, 127):
        if not (48 < b < 58 or 65 <= b <= 90):
            t[b] = n
            n += 1
    t[48:58] = t[48]
    t[65:91] = t[97:123]
    return t, n


_URL, URL_SYMBOLS = url_table()


def url_symbols(raw: np.ndarray) -> np.ndarray:
    return _URL[raw]


FOLDS = {"text": (text_symbols, TEXT_SYMBOLS), "url": (url_symbols, URL_SYMBOLS)}


def streams(column: pa.Array, fold: str, order: int, limit: int = 1_000_000) -> Iterator[tuple]:
    """(first row, end row, cuts, symbols, context codes) of runs of about ``limit`` bytes.

    ``cuts`` are the rows' places in the run; a longer text comes as several runs of one row.
    The code of a byte names the ``order`` symbols before it in its text, the latest in the
    lowest place; before the start stands the symbol ``n``."""
    symbols, n = FOLDS[fold]
    offsets, raw = text_bytes(column)
    for a, b in chunked(offsets, limit):
        for low in range(int(offsets[a]), max(int(offsets[b]), int(offsets[a]) + 1), limit):
            high = min(int(offsets[b]), low + limit) if b == a + 1 else int(offsets[b])
            cuts = np.clip(offsets[a:b + 1], low, high) - low
            lead = min(low - int(offsets[a]), order + 1)                     # bytes of the run before
            s = symbols(raw[low - lead:high]).astype(np.int64)
            since = np.arange(-lead, high - low) + (low - int(offsets[a])) if b == a + 1 else \
                np.arange(high - low) - np.repeat(cuts[:-1], np.diff(cuts))
            code = np.zeros(len(s), np.int64)
            for back in range(order, 0, -1):
                before = np.full(len(s), n, np.int64)
                before[back:] = s[:-back]
                before[since < back] = n
                code = code * (n + 1) + before
            yield a, b, cuts, s[lead:], code[lead:]
            if b > a + 1:
                break


def count_contexts(learn: DataFrame, fold: str, order: int) -> DataFrame:
    """(label, context, symbol, n) over all rows of ``learn`` (label int, text string)."""
    schema = pa.schema([("label", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
    n = FOLDS[fold][1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(label: int) -> pa.RecordBatch:
            grams, counts = held.pop(label)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), label, np.int32)), pa.array(grams), pa.array(counts)], schema=schema)

        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, cuts, s, code in streams(batch.column(1), fold, order):
                gram = code * n + s
                of = np.repeat(labels[a:b], np.diff(cuts))
                for label in np.unique(of).tolist():
                    grams, counts = np.unique(gram[of == label], return_counts=True)
                    if label in held:
                        both, at = np.unique(np.concatenate([held[label][0], grams]), return_inverse=True)
                        held[label] = [both, np.bincount(at, np.concatenate([held[label][1], counts])).astype(np.int64)]
                    else:
                        held[label] = [grams, counts.astype(np.int64)]
                    if len(held[label][0]) > 500_000:
                        yield out(label)
        for label in list(held):
            yield out(label)

    rows = learn.select("label", "text").mapInArrow(count, "label int, gram long, n long")
    return rows.groupBy("label", "gram").agg(F.sum("n").alias("n")) \
        .selectExpr("label", f"gram div {n} as context", f"cast(gram % {n} as int) as symbol", "n")


def level(counts: DataFrame, fold: str, depth: int, quota: int | None, least: int, beyond: bool = False) -> tuple[dict[str, np.ndarray], DataFrame | None]:
    """Counts of the contexts of ``depth`` that become nodes: seen at least ``least`` times over all classes, and
    among the ``quota`` most frequent ones (ties by code) of some class, all of them without a quota. With
    ``beyond``, also a table (context, label, symbol, n) of those beyond the quota; None if there are none."""
    n = FOLDS[fold][1]
    c = counts.withColumn("context", F.col("context") % (n + 1) ** depth) \
        .groupBy("label", "context", "symbol").agg(F.sum("n").alias("n"))
    of = materialise(c.groupBy("label", "context").agg(F.sum("n").alias("_n")), "of")
    seen = of.groupBy("context").agg(F.sum("_n").alias("_all")).where(F.col("_all") >= least)
    over = beyond and seen.limit(quota + 1).count() > quota
    if quota is None or (beyond and not over):
        top = seen.select("context")
    else:
        place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("_n"), "context"))
        top = of.join(seen, "context").withColumn("_place", place).where(F.col("_place") <= quota).select("context").distinct()
    got = c.join(F.broadcast(top), "context").toPandas()
    rest = None
    if over:
        rest = materialise(c.join(seen.select("context"), "context", "left_semi").join(F.broadcast(top), "context", "left_anti")
                           .select("context", "label", "symbol", "n"), "rest")
        if rest.isEmpty():
            discard(rest)
            rest = None
    discard(of)
    return {k: got[k].to_numpy(np.int64) for k in ("label", "context", "symbol", "n")}, rest


def levels(counts: DataFrame, fold: str, order: int, quota: int, least: int) -> list[dict[str, np.ndarray]]:
    """Counts by depth 0 .. ``order`` of the contexts that become nodes (see ``level``). Each class
    has its own quota, so the contexts of a small class stay however many the others have. At most
    quota x classes x symbols x classes rows of each depth reach the driver."""
    counts = materialise(counts, "contexts")
    return [level(counts, fold, depth, quota, least)[0] for depth in range(order + 1)]


def whole_levels(counts: DataFrame, fold: str, order: int, quota: int, least: int) -> tuple[list[dict[str, np.ndarray]], DataFrame | None]:
    """``levels`` that leave no context out: the shorter ones, whose number the alphabet bounds, all come to the
    driver; of the deepest ones the quota, and the rest as a table (see ``gains``)."""
    counts = materialise(counts, "contexts")
    shorter = [level(counts, fold, depth, None, least)[0] for depth in range(order)]
    deepest, rest = level(counts, fold, order, quota, least, beyond=True)
    discard(counts)
    return [*shorter, deepest], rest


def escape(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Prediction by partial matching: a symbol seen n times has n / (total + distinct); the escape,
    distinct / (total + distinct), is shared by the unseen ones as in the shorter context."""
    total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    unseen = np.where(counts > 0, 0.0, parent)
    left = unseen.sum(1, keepdims=True)
    some = total > 0
    p = counts / np.where(some, total + np.where(left > 0, distinct, 0), 1)
    spread = np.where(some, distinct / np.where(some, total + distinct, 1), 1.0)
    return np.where(some, p + np.where(left > 0, spread * unseen / np.where(left > 0, left, 1), 0), parent)


def interpolate(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Witten-Bell: (n + distinct * p_shorter) / (total + distinct)."""
    total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    return np.where(total > 0, (counts + distinct * parent) / np.where(total > 0, total + distinct, 1), parent)


@dataclass
class ContextModel:
    """Frozen code lengths: bits[node, symbol, class]."""

    fold: str
    order: int
    classes: int
    codes: np.ndarray       # sorted codes of the deepest nodes, rows ``first`` onwards of ``bits``
    first: int
    shorter: np.ndarray     # node of every code of order - 1 symbols
    bits: np.ndarray
    parents: np.ndarray | None = None    # distributions of the nodes before ``first``, while ``gains`` needs them
    rest: DataFrame | None = None        # ``gains`` of the deepest nodes beyond the quota; not for tasks

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Code length in bits of every text under every class (rows x classes)."""
        out = np.zeros((len(column), self.classes))
        n = FOLDS[self.fold][1]
        for a, b, cuts, s, code in streams(column, self.fold, self.order):
            node = self.shorter[code % (n + 1) ** (self.order - 1)]
            if len(self.codes):
                at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                node = np.where(self.codes[at] == code, self.first + at, node)
            full = np.flatnonzero(np.diff(cuts))                             # a text without bytes costs nothing
            if len(full):
                out[a + full] += np.add.reduceat(self.bits[node, s], cuts[full], axis=0, dtype=np.float64)
        return out


def freeze(fold: str, order: int, classes: int, counts: list[dict[str, np.ndarray]],
           rule: Callable[[np.ndarray, np.ndarray], np.ndarray], parents: bool = False) -> ContextModel:
    """Turn counts by depth into code lengths, each node mixed with its longest shorter node by ``rule``."""
    n = FOLDS[fold][1]
    root = np.full((1, n, classes), 1.0 / n)
    tables, rows = [root], 1
    shorter = np.zeros(1, np.int64)          # node of every code of the depth before
    all_bits = root
    codes = np.zeros(0, np.int64)
    for depth, x in enumerate(counts):
        codes = np.unique(x["context"])
        dense = np.zeros((len(codes), n, classes))
        np.add.at(dense, (np.searchsorted(codes, x["context"]), x["symbol"], x["label"]), x["n"])
        up = shorter[codes % (n + 1) ** max(depth - 1, 0)]
        tables.append(rule(dense, all_bits[up]))
        if depth < order:
            span = np.arange((n + 1) ** depth)
            shorter = shorter[span % (n + 1) ** max(depth - 1, 0)]
            shorter[codes] = rows + np.arange(len(codes))
            all_bits = np.concatenate([all_bits, tables[-1]])
            rows += len(codes)
    bits = np.concatenate([-np.log2(t).astype(np.float32) for t in tables])
    return ContextModel(fold, order, classes, codes, rows, shorter, bits, all_bits if parents else None)


def gains(rest: DataFrame, model: ContextModel, rule: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(context, gain) of the deepest nodes that ``model`` does not hold: their code lengths less those of the node
    that stands in for them there, symbol by symbol, a class after the other. ``model`` has its ``parents``."""
    shared = rest.sparkSession.sparkContext.broadcast(model)

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n = FOLDS[m.fold][1]
        for batch in batches:
            for low in range(0, len(batch), 2000):
                part = batch.slice(low, 2000)
                seen = part.column(1)
                symbol, label, count = (x.to_numpy(zero_copy_only=False) for x in seen.flatten().flatten())
                dense = np.zeros((len(part), n, m.classes))
                np.add.at(dense, (np.repeat(np.arange(len(part)), seen.value_lengths().to_numpy()), symbol, label), count)
                up = m.shorter[part.column(0).to_numpy() % (n + 1) ** (m.order - 1)]
                gain = -np.log2(rule(dense, m.parents[up])).astype(np.float32).astype(np.float64) - m.bits[up]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(gain.reshape(len(part), -1)), pa.list_(pa.float64()))], names=["context", "gain"])

    grouped = rest.groupBy("context").agg(F.collect_list(F.struct("symbol", "label", "n")).alias("seen"))
    return grouped.mapInArrow(mix, "context long, gain array<double>")


def unheld(texts: DataFrame, model: ContextModel) -> DataFrame:
    """(id, place, context, symbol) of the bytes of ``texts`` (id, text) whose deepest context ``model`` does not
    hold; places rise within a text."""
    shared = texts.sparkSession.sparkContext.broadcast(replace(model, bits=None, shorter=None, parents=None, rest=None))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, done = shared.value, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, b, cuts, s, code in streams(batch.column(1), m.fold, m.order):
                at = np.flatnonzero(~np.isin(code, m.codes))
                of = np.repeat(ids[a:b], np.diff(cuts))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (of[at], done + at, code[at], s[at])], names=["id", "place", "context", "symbol"])
                done += len(s)

    return texts.select("id", "text").mapInArrow(find, "id long, place long, context long, symbol long")
