"""Sharding, periodic runs and hard negatives against plain versions: nulls, empty and long texts, ties, repeated
rows, clashing column names, empty tables."""

import bisect
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from vatlens.llm import hard_negatives, periodic_runs, sharding

DOCS = "doc_id long, text string, shard int, end long, _row string, v int"


# ------------------------------------------------------------------------------------ op11

def plain_cuts(ends, shards):
    """Least capacity and cuts by checking on the whole list of ends."""
    total, marks = ends[-1], [0, *ends]

    def floor(x):
        return marks[bisect.bisect_right(marks, x) - 1]

    def ceil(x):
        return marks[bisect.bisect_left(marks, x)]

    def fits(c):
        at = 0
        for _ in range(shards):
            at = floor(at + c)
        return at == total
    low, high = 0, total
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    least = [total]
    for _ in range(shards - 1):
        least.append(ceil(max(least[-1] - low, 0)))
    cuts = [0]
    for i in range(1, shards):
        left = shards - i + 1
        cuts.append(min(floor(cuts[-1] + low), max(least[shards - i], ceil(cuts[-1] + -(-(total - cuts[-1]) // left)))))
    return low, cuts[1:]


def held(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    order = sorted(groups, key=lambda t: (min([i for i in groups[t] if i is not None], default=-1), hashlib.sha256(t.encode()).digest()))
    return groups, order


@pytest.fixture(scope="module")
def shard_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["ä", "stone", "river", "x"], k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000 + i, "a copy held by a third of all rows") for i in range(200)] + [(5, "again"), (5, "again"), (None, "no id"), (2000, None), (2001, ""), (2002, "y" * 3000)]
    return rows


@pytest.mark.parametrize("cells", [4, 65_536])
def test_sharding(spark, shard_rows, cells):
    docs = spark.createDataFrame([(*r, 1, 2, "own", 3) for r in shard_rows], DOCS).repartition(3)
    got = [tuple(r) for r in sharding.sharded(docs, 8, cells=cells).collect()]
    groups, order = held(shard_rows)
    sizes = [len(groups[t]) * (len(t.encode()) + 1) for t in order]
    ends = np.cumsum(sizes).tolist()
    capacity, cuts = plain_cuts(ends, 8)
    plain, slots = [], collections.Counter()
    for t, end in zip(order, ends):
        shard = sum(end > c for c in cuts)
        for i in sorted(groups[t], key=lambda x: -1 if x is None else x):
            plain.append((i, len(t.encode()) + 1, zlib.crc32(t.encode()), shard, slots[shard]))
            slots[shard] += 1
    assert sorted(got, key=str) == sorted(plain, key=str)
    load = collections.Counter()
    for _, size, _, shard, _ in got:
        load[shard] += size
    assert max(load.values()) <= capacity and len(load) == 8


def test_least_capacity_is_exact_with_few_cells(spark):
    rng = random.Random(1)
    for shards, n in ((1, 7), (3, 50), (8, 400), (5, 3)):
        sizes = [rng.choice([1, 2, 9, 500]) for _ in range(n)]
        ends = np.cumsum(sizes).tolist()
        table = spark.createDataFrame([(e,) for e in ends], "end long").cache()
        known = sharding.Ends(table, ends[-1], 4 * shards + 4)
        assert (known.least_capacity(shards), known.cuts(shards)) == plain_cuts(ends, shards)


def test_sharding_empty_and_written(spark, scratch_dir):
    docs = spark.createDataFrame([], DOCS)
    assert sharding.sharding(docs).collect() == []
    rows = [(i, f"text number {i % 7}", f"s{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sharding.write_shards(docs, f"{scratch_dir}/shards", 4)
    back = spark.read.parquet(f"{scratch_dir}/shards").collect()
    assert sorted((r.doc_id, r.text, r.source) for r in back) == sorted(rows)
    assert all(sorted(r.slot for r in back if r.shard == k) == list(range(sum(r.shard == k for r in back))) for k in range(4))
    with pytest.raises(ValueError):
        sharding.write_shards(spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, slot int"), f"{scratch_dir}/x")


def test_write_shards_names(spark):
    assert sharding.sharding(spark.createDataFrame([(1, None, 0, 0, "", 0)], DOCS)).first().asDict() == {
        "doc_id": 1, "size": 1, "text_crc32": 0, "law": "bytes", "shard": 0, "slot": 0, "grown_shard": None}


# ------------------------------------------------------------------------------------ op12

def plain_runs(words, least=12):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_runs_against_plain(spark):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        words = rng.choices(["A", "a", "bé", "c"][:rng.randint(1, 4)], k=rng.randint(0, 90))
        if rng.random() < 0.5:
            words = words[:rng.randint(0, 20)] + words[:rng.randint(1, 30)] * rng.randint(2, 6) + words
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "word " * 3000), (None, "x y " * 30), (903, "word " * 3000),
             (904, "z" * 100_000), (905, "a\x00b c " * 9), (906, "one two three " * 8)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    docs = spark.createDataFrame([(i, t, 1, 2, "own", 3) for i, t in rows], DOCS).repartition(3)
    got = sorted((tuple(r) for r in periodic_runs.document_runs(docs).collect()), key=str)
    assert got == sorted((plain_row(*r) for r in rows), key=str)
    assert periodic_runs.document_runs(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("stages", [(0, 13, 64, 1 << 62), (0, 2, 1 << 62)])
def test_runs_in_blocks(monkeypatch, stages):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(periodic_runs, "PAIRS", 40)
    monkeypatch.setattr(periodic_runs, "STAGES", stages)
    for _ in range(40):
        texts = []
        for _ in range(4):
            x = rng.integers(0, rng.integers(1, 4) + 1, rng.integers(0, 120))
            if len(x) and rng.random() < 0.6:
                a, p = int(rng.integers(0, len(x))), 1 + int(rng.integers(0, max(1, len(x) // 3)))
                at = np.arange(len(x))
                at[a:] = a + (at[a:] - a) % p
                x = x[at]
            texts.append(x.astype(np.int64))
        found = list(zip(*(c.tolist() for c in periodic_runs.find_runs(texts))))
        assert [[f[1:] for f in found if f[0] == k] for k in range(4)] == [plain_runs(t.tolist()) for t in texts]


def test_extensions_are_exact():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40, 700):
        words = np.append(np.tile(rng.integers(0, 2, n // 3 + 1), 3)[:n], -2)
        lce = periodic_runs.Extensions(words)
        i, j = rng.integers(0, n, 200), rng.integers(0, n + 1, 200)
        i, j = i[i != j], j[i != j]

        def plain(a, b):
            k = 0
            while max(a, b) + k <= n and words[a + k] == words[b + k]:
                k += 1
            return k
        assert lce(i, j).tolist() == [plain(a, b) for a, b in zip(i, j)]


def test_runs_with_text(spark):
    docs = spark.createDataFrame([(1, "go on " + "la li lu " * 5 + "end")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs, with_text=True).first()
    assert row.collapsed == "go on la li lu end" and [tuple(r) for r in row.runs] == [(2, 15, 3)]


# ------------------------------------------------------------------------------------ op13

def plain_negatives(rows, every=50, move=True):
    part = []
    for k, (vec_id, v, label) in enumerate(rows):
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        part.append((vec_id, k, (label + 1) % 10 if move and vec_id % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for a in part:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[3], b[3])), b[0], b[1], b[2]) for b in part if b[1] != a[1]]
        for p in sorted(s for s in scored if s[3] == a[2])[:5]:
            fit = sorted(s for s in scored if s[3] != a[2] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0])[:3]
            out += [(a[0], p[1], r, s[1], -p[0], -s[0]) for r, s in enumerate(fit, 1)]
    return sorted(out)


EMBEDDINGS = "vec_id long, embedding array<float>, label int, v string, block int"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 10)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, x[i].tolist(), int(rng.integers(0, 4))) for i in range(700)]
    same = x[3].tolist()
    rows += [(1000 + i, same, i % 2) for i in range(250)]                       # one very common vector, all ties
    rows += [(50, x[50].tolist(), 2), (2000, None, 1), (2050, [float("nan")] * 10, 1), (2100, [0.1] * 10, None), (2150, [None] + [0.1] * 9, 1),
             (2200, [float("inf")] * 10, 1), (2250, [], 1), (2300, [0.5], 1), (None, [0.1] * 10, 1), (2350, [0.0] * 10, 3), (-50, x[8].tolist(), 1)]
    return rows


@pytest.mark.parametrize("block, batch, tile, stride", [(131_072, 64, 8192, 16), (150, 3, 40, 3)])
def test_hard_negatives(spark, vectors, monkeypatch, block, batch, tile, stride):
    for name, value in zip(("BLOCK_ROWS", "BATCH", "TILE", "STRIDE"), (block, batch, tile, stride)):
        monkeypatch.setattr(hard_negatives, name, value)
    frame = spark.createDataFrame([(*r, "own", 1) for r in vectors], EMBEDDINGS).repartition(3)
    got = sorted(tuple(r) for r in hard_negatives.mined_embeddings(frame).collect())
    plain = plain_negatives(vectors)
    assert len(got) == len(plain)
    # rows of the same id are told apart by their row number alone, which the plain version orders by place
    assert got == plain


def test_hard_negatives_large_numbers_and_empty(spark):
    frame = spark.createDataFrame([(i, [float(x) * 2.0 ** 18 for x in ((i * 7) % 11 - 3, (i * 5) % 13 - 4)], i % 3, "", 0) for i in range(120)], EMBEDDINGS)
    got = sorted(tuple(r) for r in hard_negatives.mined_embeddings(frame).collect())
    assert got == plain_negatives([tuple(r)[:3] for r in frame.collect()])
    none = hard_negatives.mined_embeddings(spark.createDataFrame([], EMBEDDINGS))
    assert none.collect() == [] and none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_index_leaves_out_only_what_cannot_reach():
    rng = np.random.default_rng(6)
    x = np.floor(256 * rng.normal(size=(500, 12)) * np.linspace(2, 0.1, 12))
    block = hard_negatives.Block(np.arange(500), np.arange(500), np.zeros(500), x, True)
    q = x[:20]
    least = np.quantile(q @ x.T, 0.97, axis=1)
    found = [np.concatenate(c) for c in zip(*block.above(q, least))]
    a, b = np.nonzero(q @ x.T >= least[:, None])
    assert sorted(zip(*(f.tolist() for f in found))) == sorted(zip(a.tolist(), b.tolist(), (q @ x.T)[a, b].tolist()))
