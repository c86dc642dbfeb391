"""Operator 9, n-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set: the distinct ``shingle``-word shingles of its lower-cased (A-Z) words
[^\\x20\\x09-\\x0D]+; with fewer words, the whole sequence as one. Two documents link when
100 * |intersection| >= ``percent`` * |union|; groups are the connected components of the links.
The query op9 takes 3 words and 90 percent.
An empty set links with nothing. Rows are documents of their own, also if they repeat a
doc_id. Shingles are 64-bit hashes.

1. Rare first. Two tables of fixed size over all documents give one total order of all shingles: a filter
   of ``BITS`` bits tells the cells that two documents or more hit, ``CELLS`` counters the rest: shingles of
   a cell hit once come first, then by cell count, then by hash. Any total order makes the prefix
   filter exact; this one fills prefixes with shingles that no other document has. (With many more shingles than
   bits the filter fills up, and prefixes of rare shingles become plain ones: more rows, the same result.)
2. Classes. Documents of equal sets are one class with an 8-byte number, so copies never meet each other.
3. Prefixes. A set of n shingles takes part with its first n - ceil(percent n / 100) + 1 shingles.
   Linked sets share one of them, so shingles of one document alone are of no use: the filter drops most of them
   before any row leaves its task; false hits only cost rows, and exact counts drop them after the shuffle.
4. Pairs. In each shingle's group the class with the shingle earliest in its order (the one
   with the fewest shingles of its own) is the pivot, and the others are compared with it
   alone: as many pairs as rows. Links so found join classes into components. What is
   left are pairs of a class outside its pivot's component with classes of other
   components; classes of one component need no comparison, as it cannot change the groups.
5. Filters on each pair, before any set moves: length (100 min >= percent max), position (what can
   still match behind the shared shingle), and suffix (the difference of the sets' counts
   in 256 cells bounds the overlap from above). Each surviving pair is verified once.

Tables that are used up are removed at once. A group of k sets that share a prefix shingle, and of which none
links with the others, still costs up to k * k / 2 pairs in step 4 that only the filters of step 5 stop.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import cells_hit_twice, chunked, discard, drop_rows, is_set, materialise, mix, row_key, signed, small, text_bytes, word_hashes

SHINGLE, PERCENT = 3, 90
CELLS = 1 << 19
SIGNATURE = 256
#: Bits of the filter of shared shingles.
BITS = 1 << 27


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    offsets, raw = text_bytes(column)
    for a, b in chunked(offsets):
        words, first = word_hashes(offsets[a:b + 1], raw)
        runs = [mix(words)]                       # of 1, 2, .. ``shingle`` words from each word on
        with np.errstate(over="ignore"):
            for n in range(2, shingle + 1):
                before = words * np.uint64(0x9FB21C651E98DF25) if n == 2 else runs[-1] * np.uint64(0xD6E8FEB86659FD93)
                runs.append(mix(before[:-1] + words[n - 1:]) if len(words) >= n else words[:0])
        for row in range(a, b):
            low, high = int(first[row - a]), int(first[row - a + 1])
            n = high - low
            if n >= shingle:
                yield row, np.unique(runs[-1][low:high - shingle + 1])
            else:
                yield row, runs[n - 1][low:low + 1] if n else words[:0]


def cell_counts(docs: DataFrame, shingle: int, cells: int = CELLS) -> np.ndarray:
    """Shingle occurrences per hash cell over all documents; a table of fixed size, a few packed rows a task."""
    pieces = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            held, size = [], 0
            for _, s in shingle_sets(batch.column(0), shingle):
                held.append(s)
                size += len(s)
                if size > 1_000_000:
                    total += np.bincount((np.concatenate(held) % np.uint64(cells)).astype(np.int64), minlength=cells)
                    held, size = [], 0
            if held:
                total += np.bincount((np.concatenate(held) % np.uint64(cells)).astype(np.int64), minlength=cells)
        if total.any():
            kind = "<u2" if total.max() < 1 << 16 else "<i8"
            parts = total.astype(kind).reshape(pieces, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(pieces, dtype=np.int32)), pa.array([kind] * pieces), pa.array([p.tobytes() for p in parts], pa.binary())],
                                             names=["piece", "kind", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, kind, raw in zip(*(c.to_pylist() for c in batch.columns)):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(raw, kind).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["piece", "counts"])

    got = docs.select("text").mapInArrow(count, "piece int, kind string, counts binary").repartition("piece") \
        .mapInArrow(add, "piece int, counts binary").collect()             # ``cells`` counters
    out = np.zeros((pieces, cells // pieces), np.int64)
    for row in got:
        out[row["piece"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


def shared_cells(docs: DataFrame, shingle: int, bits: int | None = None) -> np.ndarray:
    """Packed bits: the cells hit by the shingles of two documents or more."""
    return cells_hit_twice(docs.select("text"), lambda column: (s for _, s in shingle_sets(column, shingle)), bits or BITS)


def postings(classes: DataFrame, shared: Broadcast) -> DataFrame:
    """(shingle, class, n, at) of the prefix shingles whose cell two documents hit."""
    def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("prefix")
            lens = np.array([len(x.as_buffer()) // 8 for x in raw], np.int64)
            s = np.frombuffer(b"".join(raw.to_pylist()), "<u8")
            keep = is_set(shared.value, s)
            place = np.arange(len(s)) - np.repeat(np.cumsum(lens) - lens, lens)
            yield pa.RecordBatch.from_arrays([pa.array(signed(s[keep])), pa.array(np.repeat(np.asarray(batch.column("class")), lens)[keep]),
                                              pa.array(np.repeat(np.asarray(batch.column("n")), lens)[keep].astype(np.int32)), pa.array(place[keep].astype(np.int32))],
                                             names=["shingle", "class", "n", "at"])

    return classes.select("class", "n", "prefix").mapInArrow(list_, "shingle long, class long, n int, at int")


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def described(docs: DataFrame, counts: np.ndarray, bits: Broadcast, shingle: int, percent: int) -> DataFrame:
    """Per row: doc_id, _md5, n, digest (of the set, NULL if empty), signature, prefix (packed hashes)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    schema = pa.schema([("doc_id", pa.int64()), ("_md5", pa.binary()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("signature", pa.binary()), ("prefix", pa.binary())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            n, cls, sig, pre = [], [], [], []
            for _, s in shingle_sets(batch.column("text"), shingle):
                n.append(len(s))
                cls.append(digest(s) if len(s) else None)
                sig.append(np.minimum(np.bincount((s >> np.uint64(40)).astype(np.int64) % SIGNATURE, minlength=SIGNATURE), 32767).astype("<i2").tobytes() if len(s) else None)
                order = np.lexsort((s, table[(s % np.uint64(len(table))).astype(np.int64)], is_set(bits.value, s)))
                pre.append(s[order[:prefix_length(len(s), percent)]].astype("<u8").tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_md5"), *(pa.array(x, f.type) for x, f in zip((n, cls, sig, pre), list(schema)[2:]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key()[1:], "text") \
        .mapInArrow(describe, "doc_id long, _md5 binary, n long, digest binary, signature binary, prefix binary")


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest()


def could_link(n1: Column, at1: Column, n2: Column, at2: Column, percent: int) -> Column:
    """Length and positional filter at a shared shingle: the overlap must reach percent / (100 + percent)
    of both sizes, and before the first shared shingle nothing matches."""
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * F.least(n1 - at1, n2 - at2) >= percent * (n1 + n2))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, b; each once). Signatures first; the sets of survivors come from
    the texts of one document a class, which are the only texts that move."""
    side = {k: classes.select(F.col("class").alias(k), F.col("signature").alias(f"s{k}"), F.col("n").alias(f"n{k}")) for k in "ab"}
    known = pairs.join(side["a"], "a").join(side["b"], "b")

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sa, sb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<i2").reshape(-1, SIGNATURE).astype(np.int64) for k in ("sa", "sb"))
                both = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
                apart = np.abs(sa - sb).sum(1)                      # at most the symmetric difference
                full = (sa == 32767).any(1) | (sb == 32767).any(1)
                keep = pa.array(full | ((100 + percent) * (both - apart) >= 2 * percent * both))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)

    near = materialise(known.mapInArrow(suffix, "a long, b long"), "near")
    needed = materialise(near.select(F.col("a").alias("class")).union(near.select("b")).distinct()
                         .join(classes.select("class", "digest", F.col("doc_id").alias("_id")), "class"), "needed")
    moved = texts.join(small(needed), texts["doc_id"].eqNullSafe(F.col("_id"))).select("class", "digest", "text")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, sets = [], []
            for (_, s), c, d in zip(shingle_sets(batch.column("text"), shingle), batch.column("class").to_pylist(), batch.column("digest").to_pylist()):
                if len(s) and digest(s) == d:                        # not another text of the same doc_id
                    cls.append(c)
                    sets.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], names=["class", "set"])

    sets = materialise(moved.mapInArrow(rebuild, "class long, set binary").dropDuplicates(["class"]), "sets")
    filled = near.join(sets.select(F.col("class").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("class").alias("b"), F.col("set").alias("sb")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                linked.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    links = materialise(filled.select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long"), "links")
    discard(near, needed, sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """(class, root) of every linked class: large-star and small-star steps until nothing changes."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def star(e: DataFrame, both: bool) -> DataFrame:
        near = e.union(e.select("v", "u")) if both else e
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        moved = near.join(low, "u")
        if both:        # every larger neighbour points to the least of the neighbourhood
            return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every smaller neighbour, and the node itself, points to the least
        return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        edges = materialise(star(star(edges, True), False), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("class"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def linked_classes(classes: DataFrame, prefixes: DataFrame, bits: Broadcast, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(class, root) of every class that links with another. ``prefixes`` (class, n, prefix) is used up."""
    every = materialise(postings(prefixes, bits), "every")
    discard(prefixes)
    shared = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("_k"), F.min(F.struct("at", "n", "class")).alias("_pivot")).where("_k > 1").drop("_k")
    shared = materialise(shared, "shared")       # a table of its own, so that the join below can split a hot shingle
    held = materialise(every.join(shared, "shingle"), "postings")
    discard(every, shared)
    pivot = {k: F.col(f"_pivot.{k}") for k in ("class", "n", "at")}
    first = held.where((F.col("class") != pivot["class"]) & could_link(F.col("n"), F.col("at"), pivot["n"], pivot["at"], percent))
    first = materialise(first.select(F.least("class", pivot["class"]).alias("a"), F.greatest("class", pivot["class"]).alias("b")).distinct(), "first")
    links = verified(first, classes, texts, shingle, percent)
    root = materialise(components(links), "roots")
    # a class outside its pivot's component meets the classes of other components in the group
    at_pivot = root.select(F.col("class").alias("_pc"), F.col("root").alias("_proot"))
    placed = held.join(root, "class", "left").withColumn("root", F.coalesce("root", "class")) \
        .join(at_pivot, F.col("_pivot.class") == F.col("_pc"), "left").withColumn("_proot", F.coalesce("_proot", F.col("_pivot.class"))) \
        .select("shingle", "class", "n", "at", "root", (F.col("root") != F.col("_proot")).alias("out"))
    placed = materialise(placed, "placed")
    discard(held)
    rest, group = placed.where("out"), placed
    l, r = rest.alias("l"), group.alias("r")
    second = l.join(r, (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.root") != F.col("r.root"))
                    & (~F.col("r.out") | (F.col("l.class") < F.col("r.class")))
                    & could_link(F.col("l.n"), F.col("l.at"), F.col("r.n"), F.col("r.at"), percent))
    second = second.select(F.least("l.class", "r.class").alias("a"), F.greatest("l.class", "r.class").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = verified(second, classes, texts, shingle, percent)
    discard(placed, first)
    return materialise(components(links.union(more)), "roots") if not more.isEmpty() else root


def grouped(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, _md5, n, _root) per row, as a table; _root is NULL for an empty set."""
    bits = docs.sparkSession.sparkContext.broadcast(shared_cells(docs, shingle))
    rows = materialise(described(docs, cell_counts(docs, shingle), bits, shingle, percent), "described")
    found = rows.where("digest is not null").groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "n", "signature", "prefix"), F.struct("doc_id", "_md5")).alias("_r")) \
        .select("digest", "_r.*", F.monotonically_increasing_id().alias("class"))
    found = materialise(found, "classes")
    prefixes, classes = materialise(found.select("class", "n", "prefix"), "prefixes"), materialise(found.drop("prefix"), "classes")
    slim = materialise(rows.select("doc_id", "_md5", "n", "digest"), "rows")
    discard(rows, found)
    root = linked_classes(classes, prefixes, bits, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle, percent)
    names = classes.select("class", "digest")
    linked = root.join(names, "class").join(names.select(F.col("class").alias("root"), F.col("digest").alias("_to")), "root").select("digest", "_to")
    out = materialise(slim.join(linked, "digest", "left").select("doc_id", "_md5", "n", F.coalesce("_to", "digest").alias("_root")), "grouped")
    discard(slim, classes)
    bits.destroy()
    return out


def ngram_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest doc_id reachable by links."""
    found = grouped(docs, shingle, percent)
    # a table of its own, so that the join can split the rows of a large component
    least = materialise(found.where("_root is not null").groupBy("_root").agg(F.min("doc_id").alias("_least")), "least")
    return found.join(least, "_root", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                     F.coalesce("_least", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group, the smallest doc_id (ties: the smallest digest of the
    text, then any of equal rows); rows with empty sets all stay."""
    found = grouped(docs, shingle, percent)
    held = found.where("_root is not null").groupBy("_root", "doc_id", "_md5").agg(F.count(F.lit(1)).alias("_n"))
    win = materialise(held.groupBy("_root").agg(F.min(F.struct("doc_id", "_md5")).alias("_w")), "winners")
    won = F.col("doc_id").eqNullSafe(F.col("_w.doc_id")) & (F.col("_md5") == F.col("_w._md5"))
    losers = materialise(held.join(win, "_root").where(~won | (F.col("_n") > 1)).select("doc_id", "_md5", (~won).alias("_all")), "losers")
    discard(found, win)
    return drop_rows(docs, losers)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
classes AS (SELECT min(doc_id) AS id, list_sort(s) AS s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY ALL),
t AS (SELECT id, n, unnest(s) AS g FROM classes),
pairs AS (SELECT a.id AS x, b.id AS y FROM t a JOIN t b ON a.g = b.g AND a.id < b.id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
          GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (SELECT id, id AS r FROM classes UNION SELECT reach.id, e.y FROM reach JOIN e ON reach.r = e.x),
root AS (SELECT id, min(r) AS root FROM reach GROUP BY id),
member AS (SELECT s.doc_id, len(s.s) AS n, c.id FROM s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = c.s)
SELECT doc_id, n AS n_shingles, coalesce(root.root, doc_id) AS component_id FROM member LEFT JOIN root USING (id)
"""
