"""Operator 5, language-model scoring with a weighted backoff automaton.

Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, then one end per text; NULL is the
empty text. The model interpolates n-grams of up to ``order`` tokens with absolute
discounting, over all tokens and every longer n-gram seen ``LEAST`` times. Each context with
n-grams of its own is a state, each of its n-grams an arc, and each state has a failure arc with
the backoff weight to the next shorter context's state.

The weights are pushed so that they add up: an arc holds log10(1 + own / (left * p(tail))), what it
gains over the failure path, and a state its failure weight log10(left). An n-gram that does not end
a text is followed by one token, so it always pays its state's weight; so a text's score is a sum
over its n-grams of one weight each, and n-grams without a weight add nothing.

* A filter of ``BITS`` bits holds the cells that longer n-grams hit twice. An n-gram whose cell is not set was
  seen once at most: it is not sent to be counted, and no text looks it up. False hits only cost bytes, as
  exact counts follow. With many more n-grams than bits the filter fills up, and everything is sent.
* Counts and weights of all n-grams: tables in the shared folder that grow with the corpus.
* Tokens of at least ``common`` of all tokens, and n-grams of at least ``arcs`` of them: at most
  1 / common and 1 / arcs of each order, broadcast.
* All other n-grams of the texts meet the weights in a shuffle by hash buckets, packed. An n-gram
  there is rare, so buckets are even; their number grows with the bytes of text.

The unigrams are proper over the distinct training tokens and one unseen type, as those of
the base score: a seen token has (c - D) / N, the unseen type D * V / N.
Tokens are known by 64-bit hashes. Texts that repeat a doc_id are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import cells_hit_twice, chunked, discard, fold, is_set, materialise, mix, signed, text_bytes, unmix, word_hashes

ORDER = 3
COMMON, ARCS = 1e-6, 4e-6
#: Times that an n-gram of two tokens or more is seen, to be in the model.
LEAST = 2
DISCOUNT = 0.75
#: Tokens whose n-grams a task holds before it sends their counts, and before it sends their questions. They
#: bound a worker's memory: a token has up to ``order`` of each, some 50 bytes apiece while they are sorted.
BLOCK_TOKENS, ASK_TOKENS = 1_000_000, 400_000
#: Bits of the filter of n-grams seen twice.
BITS = 1 << 27
#: Bytes of text a hash bucket. A task holds one bucket's counts, or its questions and weights, at a time.
BUCKET_BYTES = 8_000_000
#: Parts of the texts that are scored one after the other.
PARTS = 2
FACTOR = np.uint64(0x9FB21C651E98DF25)
#: The end token's hash.
END = np.uint64(0x5851F42D4C957F2D)


def token_runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens, place of each row's first token and the end)."""
    offsets, raw = text_bytes(column)
    for a, b in chunked(offsets):
        words, first = word_hashes(offsets[a:b + 1], raw)
        starts = first + np.arange(b - a + 1)
        tokens = np.empty(len(words) + b - a, np.uint64)
        ends = starts[1:] - 1
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner], tokens[ends] = words, END
        yield a, b, tokens, starts


def ngrams(tokens: np.ndarray, starts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 .. order: (hash of the n-gram that ends at each token, whether it lies in one text).

    A hash is made of those of the n-gram without its last and without its first token."""
    place = np.arange(len(tokens)) - np.repeat(starts[:-1], np.diff(starts))
    out = [(tokens, np.ones(len(tokens), bool))]
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            last = out[-1][0]
            before = np.zeros_like(tokens)
            before[1:] = last[:-1]                # the (n-1)-gram that ends one token earlier
            out.append((mix(before * FACTOR + last + np.uint64(n)), place >= n - 1))
    return out


def context_of(grams: np.ndarray, tails: np.ndarray, n: int) -> np.ndarray:
    """The n-grams without their last token, from them and what they are without their first."""
    with np.errstate(over="ignore"):
        return (unmix(grams) - tails - np.uint64(n)) * np.uint64(pow(int(FACTOR), -1, 1 << 64))


def bucket_count(texts: DataFrame) -> int:
    return int(texts.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // BUCKET_BYTES + 1


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def packed(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def merged(grams: np.ndarray, tails: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each n-gram once, sorted, with its tail and the sum of its times."""
    at = np.argsort(grams, kind="stable")
    grams = grams[at]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else at
    return grams[first], tails[at][first], np.add.reduceat(times[at], first) if len(grams) else times


def seen_twice(train: DataFrame, order: int, bits: int) -> np.ndarray:
    """Packed bits: the cells that n-grams of two tokens or more hit twice."""
    def hashes(column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, tokens, starts in token_runs(column):
            for gram, inside in ngrams(tokens, starts, order)[1:]:
                yield gram[inside]

    return cells_hit_twice(train.select("text"), hashes, bits)


def gather(train: DataFrame, order: int, buckets: int, twice: Broadcast, shortest: int = 1) -> DataFrame:
    """(n, gram, times, context, tail): exact counts of all tokens, and of every longer n-gram seen LEAST times; of
    the lengths ``shortest`` .. ``order`` only."""
    kinds = [("grams", "<u8"), ("tails", "<u8"), ("times", "<i8")]

    def block(parts: list[list]) -> Iterator[pa.RecordBatch]:
        for n, part in enumerate(parts, shortest):
            held = merged(*(packed([x[k] for x in part]) for k in (0, 1)), np.ones(sum(len(x[0]) for x in part), np.int64))
            at = np.argsort(bucket_of(held[0], buckets), kind="stable")
            cuts = np.searchsorted(bucket_of(held[0], buckets)[at], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            columns = [pa.array([x[at[cuts[b]:cuts[b + 1]]].astype(kind).tobytes() for b in some], pa.binary()) for x, (_, kind) in zip(held, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), n, np.int32)), *columns],
                                             names=["bucket", "n", *(k for k, _ in kinds)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [[] for _ in range(shortest, order + 1)], 0
        for batch in batches:
            for _, _, tokens, starts in token_runs(batch.column(0)):
                grams = ngrams(tokens, starts, order)
                for n, (part, (gram, inside)) in enumerate(zip(parts, grams[shortest - 1:]), shortest - 1):
                    if n:
                        inside = inside & is_set(twice.value, gram)
                    part.append((gram[inside], grams[n - 1][0][inside] if n else np.zeros(len(gram), np.uint64)))
                size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield from block(parts)
                    parts, size = [[] for _ in range(shortest, order + 1)], 0
        if size:
            yield from block(parts)

    def add(rows: pa.Table) -> pa.Table:
        out, order_of = [], np.asarray(rows.column("n"))
        for n in range(shortest, order + 1):
            of = rows.filter(pa.array(order_of == n))
            grams, tails, times = merged(*(np.frombuffer(b"".join(of.column(k).to_pylist()), kind) for k, kind in kinds))
            keep = times >= (LEAST if n > 1 else 1)
            grams, tails, times = grams[keep], tails[keep], times[keep]
            context = context_of(grams, tails, n) if n > 1 else tails
            out.append(pa.table([pa.array(np.full(len(grams), n, np.int32)), pa.array(signed(grams)), pa.array(times), pa.array(signed(context)), pa.array(signed(tails))],
                                names=["n", "gram", "times", "context", "tail"]))
        return pa.concat_tables(out)

    return train.select("text").mapInArrow(count, "bucket int, n int, grams binary, tails binary, times binary") \
        .groupBy("bucket").applyInArrow(add, "n int, gram long, times long, context long, tail long")


def find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each x in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


@dataclass
class Automaton:
    """The broadcast part. tokens/token_log/base_log: common tokens; arcs: for n = 2 .. order the
    frequent n-grams (sorted) and their weights; rest: for n = 1 .. order, whether there are others;
    unseen: weight and base of an unseen token; twice: the filter of n-grams seen twice."""

    order: int
    tokens: np.ndarray
    token_log: np.ndarray
    base_log: np.ndarray
    arcs: list[tuple[np.ndarray, np.ndarray]]
    rest: list[bool]
    unseen: tuple[float, float]
    twice: np.ndarray

    def follow(self, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Per token: the broadcast weights of the n-grams that end there; the base; for each n whether
        the n-gram's weight (and the base) is to be looked up; whether the token is held here; the n-grams."""
        at, common = find(self.tokens, tokens)
        grams = ngrams(tokens, starts, self.order)
        out, base = (np.full(len(tokens), 0.0 if self.rest[0] else x) for x in self.unseen)
        if len(self.tokens):
            out, base = np.where(common, self.token_log[at], out), np.where(common, self.base_log[at], base)
        ask = [~common & self.rest[0]]
        for (keys, weights), rest, (gram, inside) in zip(self.arcs, self.rest[1:], grams[1:]):
            passing = np.flatnonzero(inside & is_set(self.twice, gram))      # all others were seen once at most
            at, arc = find(keys, gram[passing])
            if len(keys):
                out[passing] += np.where(arc, weights[at], 0.0)
            wanted = np.zeros(len(tokens), bool)
            wanted[passing] = ~arc & rest
            ask.append(wanted)
        return out, base, np.array(ask), common, [gram for gram, _ in grams]

    def walk(self, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.follow(tokens, starts)[:3]


@dataclass
class Totals:
    tokens: int
    types: int
    discount: float

    def base(self, c):
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def seen(self, c):
        return np.log10((c - self.discount) / self.tokens)

    def unseen(self) -> float:
        return float(np.log10(self.discount * self.types / self.tokens)) if self.types else 0.0


def unsigned(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64)


def weigh(counts: DataFrame, total: Totals, order: int) -> DataFrame:
    """(n, gram, times, weight, known, base): an arc's weight (a token's log10 p, with its base and known = 1),
    and for a gram that is a state its failure weight in a row of its own. ``counts`` is not read any more then."""
    size = max(total.tokens, 1)
    nothing = [F.lit(0).alias("known"), F.lit(0.0).alias("base")]
    lower = counts.where("n = 1").select("gram", "times", F.log10((F.col("times") - total.discount) / size).alias("p"))
    lower = materialise(lower, "tokens")
    out = lower.select(F.lit(1).alias("n"), "gram", "times", F.col("p").alias("weight"), F.lit(1).alias("known"),
                       F.log10((F.col("times") + 0.5) / (size + 0.5 * (total.types + 1))).alias("base"))
    for n in range(2, order + 1):
        own = counts.where(F.col("n") == n).drop("n")
        used = own.groupBy("context").agg(F.sum(F.col("times") - DISCOUNT).alias("used"))
        states = materialise(used.join(lower.select(F.col("gram").alias("context"), F.col("times").alias("seen")), "context")
                             .select("context", "seen", (1 - F.col("used") / F.col("seen")).alias("left")), "states")
        gain = (F.col("times") - DISCOUNT) / F.col("seen") / (F.col("left") * F.pow(F.lit(10.0), "low"))
        arcs = own.join(states, "context").join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("low")), "tail") \
            .select("gram", "times", F.log10(1 + gain).alias("weight"), (F.log10(1 + gain) + F.log10("left") + F.col("low")).alias("p"))
        lower = materialise(arcs if n < order else arcs.drop("p"), "arcs")
        out = out.union(lower.select(F.lit(n), "gram", "times", "weight", *nothing)) \
            .union(states.select(F.lit(n - 1), "context", "seen", F.log10("left"), *nothing))
    return out


def train_automaton(train: DataFrame, order: int = ORDER, common: float = COMMON, arcs: float = ARCS, bits: int = BITS) -> tuple[Totals, DataFrame, Automaton]:
    """Totals, the weights of the n-grams that are not broadcast (see ``weigh``), and the broadcast part."""
    passing = seen_twice(train, order, bits)
    shared = train.sparkSession.sparkContext.broadcast(passing)
    # the shuffle of a count holds most n-grams of the texts: that of the shorter ones is gone when the longest are counted
    buckets, cuts = bucket_count(train), [0, min(2, order), *range(3, order + 1)]
    parts = [materialise(gather(train, b, buckets, shared, a + 1), "counts") for a, b in zip(cuts, cuts[1:])]
    counts = reduce(DataFrame.union, parts)
    shared.destroy()
    size, types, once, twice = counts.where("n = 1").select(F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1)),
                                                            F.count_if(F.col("times") == 1), F.count_if(F.col("times") == 2)).first()
    total = Totals(size, types, min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5)
    weights = weigh(counts, total, order)
    discard(*parts)
    frequent = F.col("times") >= F.when(F.col("n") == 1, common * size).otherwise(arcs * size)
    got = weights.where(frequent).toPandas()     # at most 2 / common tokens and 2 / arcs rows of each longer order
    held = []
    for n in range(1, order + 1):
        x = got[got["n"] == n].groupby("gram")[["weight", "base"]].sum()
        gram = unsigned(x.index.to_numpy())
        at = np.argsort(gram)
        held.append((gram[at], x["weight"].to_numpy(float)[at], x["base"].to_numpy(float)[at]))
    model = Automaton(order, *held[0], [x[:2] for x in held[1:]], [common * size > 1] + [arcs * size > LEAST] * (order - 1),
                      (total.unseen(), float(total.base(0))), passing)
    return total, weights.where(~frequent), model


#: Sums of a text, and the parts of a packed question.
SUMS = [("n_tokens", "long"), ("_known", "long"), ("_base", "double"), ("_score", "double")]
ASKED = [("bucket", "int"), ("token", "boolean"), ("rows", "binary"), ("lens", "binary"), ("grams", "binary")]


def score(docs: DataFrame, total: Totals, weights: DataFrame, model: Automaton) -> DataFrame:
    """``docs`` without text, plus n_tokens, n_known, base_score, score.

    The texts are scored in ``PARTS`` by their hash, one after the other: the shuffle of a part is gone when the next begins."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(model), bucket_count(docs)
    part = F.pmod(F.xxhash64(*docs.columns), F.lit(PARTS))
    return reduce(DataFrame.union, [materialise(score_part(docs.where(part == k), total, weights, model.unseen, shared, buckets), "scores") for k in range(PARTS)])


def score_part(docs: DataFrame, total: Totals, weights: DataFrame, unseen: tuple[float, float], shared: Broadcast, buckets: int) -> DataFrame:
    """``score`` of a part of the texts.

    One pass over the texts gives a row for each text, with the sums of its broadcast weights, and its questions for
    the other n-grams, packed by hash bucket. Both go through one shuffle, in which each bucket's questions meet its
    weights, and are summed by row; so rows are numbered and read once."""
    others = [c for c in docs.columns if c != "text"]
    held = [f"_c{i}" for i in range(len(others))]
    flat = docs.select(*others, "text").toDF(*held, "text").withColumn("_row", F.monotonically_increasing_id())
    kinds = [("rows", "<i8"), ("lens", "<i4"), ("grams", "<u8")]
    result = [f"{f.name} {f.dataType.simpleString()}" for f in flat.select(*held).schema] + ["_row long"] + [f"{n} {k}" for n, k in SUMS]
    names = [*held, "_row", *(n for n, _ in SUMS)]

    def nothing(like: pa.Schema, n: int, columns: list[str]) -> list[pa.Array]:
        return [pa.nulls(n, like.field(c).type) for c in columns]

    def block(like: pa.Schema, parts: list[list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        """Questions of tokens and of longer n-grams, each in the order of rows, a row a bucket."""
        for token, part in zip((True, False), parts):
            r, g = (np.concatenate([x[k] for x in part]) for k in range(2))
            bucket = bucket_of(g, buckets)
            at = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            r, g, cuts = r[at], g[at], np.searchsorted(bucket[at], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            out = [[], [], []]
            for b in some:
                rows = r[cuts[b]:cuts[b + 1]]
                first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                for column, x, (_, kind) in zip(out, (rows[first], np.diff(np.append(first, len(rows))), g[cuts[b]:cuts[b + 1]]), kinds):
                    column.append(x.astype(kind).tobytes())
            no = [*nothing(like, len(some), [*held, "_row"]), *(pa.nulls(len(some), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*no, pa.array(some.astype(np.int32)), pa.array(np.full(len(some), token)), *(pa.array(x, pa.binary()) for x in out)],
                                             names=[*names, *(n for n, _ in ASKED)])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, like = ([], []), 0, None
        for batch in batches:
            ids, like = np.asarray(batch.column("_row")), batch.schema
            for a, b, tokens, starts in token_runs(batch.column("text")):
                logs, base, wanted, common, grams = shared.value.follow(tokens, starts)
                sums = [np.diff(starts), *(np.add.reduceat(x, starts[:-1]) for x in (common.astype(np.int64), base, logs))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in [*held, "_row"]] + [pa.array(x) for x in sums]
                    + [pa.array((ids[a:b] % buckets).astype(np.int32)), *(pa.nulls(b - a, t) for t in (pa.bool_(), *[pa.binary()] * 3))],
                    names=[*names, *(n for n, _ in ASKED)])
                row = np.repeat(ids[a:b], np.diff(starts))
                longer = wanted[1:].T
                parts[0].append((row[wanted[0]], tokens[wanted[0]]))
                parts[1].append((row[np.nonzero(longer)[0]], np.array(grams[1:], np.uint64).reshape(-1, len(tokens)).T[longer]))
                size += len(tokens)
                if size >= ASK_TOKENS:
                    yield from block(like, parts)
                    parts, size = ([], []), 0
        if size:
            yield from block(like, parts)

    def answer(asked: pa.Table, table: pa.Table) -> pa.Table:
        keys, of = np.unique(unsigned(table.column("gram").to_numpy()), return_inverse=True)
        value = {k: np.bincount(of, table.column(k).to_numpy().astype(float), minlength=len(keys)) for k in ("weight", "known", "base")}
        texts = asked.filter(pc.is_null(asked.column("grams"))).select(names)
        parts = [texts]
        for one in (True, False):
            part = asked.filter(pc.equal(asked.column("token"), one))
            rows, lens, grams = (np.frombuffer(b"".join(part.column(k).to_pylist()), kind) for k, kind in kinds)
            if not len(grams):
                continue
            at, hit = find(keys, grams)
            got = {k: np.where(hit, v[at], 0.0) if len(keys) else np.zeros(len(grams)) for k, v in value.items()}
            if one:
                seen = got["known"] > 0
                got["weight"], got["base"] = np.where(seen, got["weight"], unseen[0]), np.where(seen, got["base"], unseen[1])
            begin = np.cumsum(lens) - lens
            known, base, weight = (np.add.reduceat(got[k], begin) for k in ("known", "base", "weight"))
            sums = [rows, np.zeros(len(rows), np.int64), known.astype(np.int64), base, weight]
            parts.append(pa.table(nothing(texts.schema, len(rows), held) + [pa.array(x) for x in sums], names=names).cast(texts.schema))
        return pa.concat_tables(parts)

    asked = flat.mapInArrow(ask, ", ".join(result + [f"{n} {k}" for n, k in ASKED]))
    # the bucket of the signed hash: its upper half as an unsigned number
    bucket = F.pmod(F.shiftrightunsigned("gram", 32), F.lit(buckets)).cast("int").alias("bucket")
    summed = asked.groupBy("bucket").cogroup(weights.select(bucket, "gram", "weight", "known", "base").groupBy("bucket")).applyInArrow(answer, ", ".join(result)) \
        .groupBy("_row").agg(*(F.any_value(c, True).alias(c) for c in held), *(F.sum(c).alias(c) for c, _ in SUMS))
    return summed.select(*held, "n_tokens", "_known", F.lit(total.tokens).cast("long"), "_base", "_score") \
        .toDF(*others, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def held_out_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    out = fold("doc_id", 5) == 1
    total, weights, model = train_automaton(docs.where(~out).select("text"))
    return score(docs.select("doc_id", out.alias("held_out"), "text"), total, weights, model)
