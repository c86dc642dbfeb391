"""Operator 12, periodic run detection by LCE queries over a difference cover.

A run of a text's words is a stretch with smallest period q (words q apart are identical), at least
``max(least, 2 q)`` words long, that no neighbouring word extends keeping period q. Words are
[^\\x20\\x09-\\x0D]+, compared byte by byte (exact ids, no hashes).

1. Harmonic grid. For every period q the words at multiples of max(q, least - q) are compared with
   those q further on: the equal words of a run make a stretch of at least that length, which holds a grid
   point. That is n / q points a period, n log n in all. Equal pairs are extended to both sides.
2. Extension. Few words are compared directly. A pair that stays equal goes on to the place
   where both sides fall on the difference cover {0, 1, 3, 9} modulo 13 (fewer than 13 words
   further, compared directly); from there the longest common extension is the least value between the
   two suffixes' ranks in the order of the sampled suffixes, by a sparse table. Backward extensions
   are those of the reversed words.
3. Only cover-sampled suffixes (4 of 13) are sorted: by blocks of 13 words, then by doubling
   the number of blocks. They are built for those texts alone in which a pair reaches them.
4. The same stretch found with several periods is kept with the smallest, which is always found too.
   Pairs inside a run found before, at a multiple of its period, would find it again and are passed over.

Texts are handled in chunks of about ``CHUNK_BYTES``, grid pairs in blocks, so memory is bounded by the
longest text, and a long text takes time n log n. A NULL or empty text has no words and no runs. Repeated
rows are rows of their own; a NULL doc_id has the text form ''.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run in words.
LEAST = 12
#: A difference cover: every difference modulo 13 is one of two members (a perfect difference set).
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Words compared directly on each side before the sampled suffixes are asked.
NEAR = 13
CHUNK_BYTES, PAIRS = 1_000_000, 1_000_000
#: Periods are tried in these stages; what lies in a run of an earlier one is not extended again.
STAGES = (0, 13, 64, 1 << 62)


def cover_shifts() -> np.ndarray:
    """[a, b]: the least d for which a + d and b + d both lie in the cover, modulo MODULUS."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    ahead = np.array([inside[a:a + MODULUS] for a in range(MODULUS)])
    return np.argmax(ahead[:, None] & ahead[None], axis=2)


SHIFTS = cover_shifts()


class Extensions:
    """Longest common extensions of places in ``words``, whose last word is found nowhere else."""

    def __init__(self, words: np.ndarray):
        self.words, n = words, len(words)
        at = np.arange(n)
        self.at = np.flatnonzero(np.isin(at % MODULUS, COVER))           # sampled places
        self.number = np.full(n + MODULUS, -1, np.int64)
        self.number[self.at] = np.arange(len(self.at))
        padded = np.concatenate([words, np.full(MODULUS, -1, words.dtype)])
        blocks = np.lexsort([padded[self.at + k] for k in range(MODULUS - 1, -1, -1)])
        change = np.zeros(len(blocks), bool)
        for k in range(MODULUS):
            column = padded[self.at + k][blocks]
            change[1:] |= column[1:] != column[:-1]
        rank = np.empty(len(blocks), np.int64)
        rank[blocks] = np.cumsum(change)
        ranks, span, order = [rank], 1, blocks                             # ranks[j]: by the first 2**j blocks
        while len(rank) and rank.max() < len(rank) - 1:
            after = self.follow(rank, self.at + MODULUS * span)
            order = np.lexsort([after, rank])
            a, b = rank[order], after[order]
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            ranks.append(rank)
            span *= 2
        self.rank = rank
        left, right = self.at[order[:-1]], self.at[order[1:]]
        self.least = [self.common_blocks(ranks, left, right)]             # sparse table over neighbours' blocks in common
        while len(self.least[-1]) > 1 << len(self.least) - 1:
            half = 1 << len(self.least) - 1
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def follow(self, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rank at each of the sampled ``places``; -1 behind the end."""
        number = self.number[np.minimum(places, len(self.number) - 1)]
        return np.where(number >= 0, rank[number], -1)

    def common_blocks(self, ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whole blocks that suffixes at sampled places have in common, by the ranks of 2**j blocks."""
        done = np.zeros(len(left), np.int64)
        for j in range(len(ranks) - 1, -1, -1):
            a, b = self.follow(ranks[j], left + MODULUS * done), self.follow(ranks[j], right + MODULUS * done)
            done += np.where((a == b) & (a >= 0), 1 << j, 0)
        return done

    def direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words in common from i and j on, ``most`` at most."""
        n, out, live = len(self.words), np.zeros(len(i), np.int64), np.arange(len(i))
        while len(live):
            k = out[live]
            a, b = i[live] + k, j[live] + k
            go = (k < most[live]) & (a < n) & (b < n)
            go[go] = self.words[a[go]] == self.words[b[go]]
            live = live[go]
            out[live] += 1
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words in common from i and from j on (i and j differ)."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        out = self.direct(i, j, shift)
        through = np.flatnonzero((out == shift) & (np.maximum(i, j) + shift < len(self.words)))
        a, b = i[through] + shift[through], j[through] + shift[through]
        x, y = self.rank[self.number[a]], self.rank[self.number[b]]
        x, y = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((y - x).astype(float))[1] - 1                       # floor(log2)
        blocks = np.empty(len(through), np.int64)
        for k in np.unique(level):
            of = level == k
            blocks[of] = np.minimum(self.least[k][x[of]], self.least[k][y[of] - (1 << int(k))])
        a, b = a + MODULUS * blocks, b + MODULUS * blocks
        out[through] += MODULUS * blocks + self.direct(a, b, np.full(len(a), MODULUS))
        return out


def grid(starts: np.ndarray, sizes: np.ndarray, least: int, over: int, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the grid points of periods over+1 .. upto, about PAIRS at a time. Text k has
    ``sizes[k]`` words from ``starts[k]``."""
    some = np.flatnonzero((sizes >= least) & (sizes // 2 > over))
    periods = np.minimum(sizes[some] // 2, upto) - over
    text = np.repeat(some, periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1 + over
    step = np.maximum(q, least - q)
    points = -(-(sizes[text] - q) // step)
    total = np.cumsum(points)
    row = 0
    while row < len(text):
        base = int(total[row - 1]) if row else 0
        end = max(row + 1, int(np.searchsorted(total, base + PAIRS, "right")))
        many = points[row:end]
        k = np.arange(int(total[end - 1]) - base) - np.repeat(total[row:end] - many - base, many)
        t = np.repeat(text[row:end], many)
        yield t, starts[t] + k * np.repeat(step[row:end], many), np.repeat(q[row:end], many)
        row = end


def near(words: np.ndarray, i: np.ndarray, j: np.ndarray, sign: int) -> tuple[np.ndarray, np.ndarray]:
    """Words in common from i and j on (backward: sign -1), NEAR at most, and whether all NEAR were."""
    out, live = np.zeros(len(i), np.int64), np.arange(len(i))
    for k in range(NEAR):
        live = live[words[i[live] + sign * k] == words[j[live] + sign * k]]
        out[live] += 1
        if not len(live):
            break
    return out, out == NEAR


def inside_runs(runs: list[np.ndarray], text: np.ndarray, i: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """Which pairs (i, i + q) lie in a known run (text, start, length, period) whose period divides q: they would find
    that run again. Looked up is the last run that starts up to i."""
    key = runs[0] * n + runs[1]
    order = np.argsort(key)
    at = np.searchsorted(key[order], text * n + i, "right") - 1
    own = order[np.maximum(at, 0)]
    of, start, length, period = (x[own] for x in runs)
    return (at >= 0) & (of == text) & (i + q < start + length) & (q % period == 0)


def find_runs(texts: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run of the texts (arrays of word ids from 0 on), by text, start, period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    # texts one after the other, a word of its own before each and after the last
    words = np.concatenate([x for k, t in enumerate(texts) for x in ([-2 - k], t)] + [[-2 - len(texts)]]).astype(np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    runs = [np.zeros(0, np.int64) for _ in range(4)]                      # text, start (in ``words``), length, period
    for over, upto in zip(STAGES, STAGES[1:]):
        found = []
        for text, i, q in grid(starts, sizes, least, over, upto):
            equal = np.flatnonzero(words[i] == words[i + q])
            text, i, q = text[equal], i[equal], q[equal]
            if len(runs[0]):
                fresh = ~inside_runs(runs, text, i, q, len(words))
                text, i, q = text[fresh], i[fresh], q[fresh]
            ahead, far = near(words, i, i + q, 1)
            back, deep = near(words, i - 1, i + q - 1, -1)
            # one side still open, or both ended and the stretch long enough
            keep = far | deep | (ahead + back + q >= np.maximum(least, 2 * q))
            # the point before reaches this one: the same stretch
            gap = i[1:] - i[:-1]
            keep[1:] &= (text[1:] != text[:-1]) | (q[1:] != q[:-1]) | (ahead[:-1] < gap)
            found.append([x[keep] for x in (text, i, q, ahead, far, back, deep)])
        if not found:
            continue
        text, i, q, ahead, far, back, deep = (np.concatenate([f[k] for f in found]) for k in range(7))
        for still_open, sign, length in ((far, 1, ahead), (deep, -1, back)):
            rows = np.flatnonzero(still_open)
            if not len(rows):
                continue
            # the texts in which a pair goes on, in a sequence of their own
            own = np.unique(text[rows])
            begin = np.zeros(len(texts), np.int64)
            begin[own] = np.cumsum(sizes[own] + 1) - sizes[own] - 1
            lce = Extensions(np.concatenate([words[starts[k]:starts[k] + sizes[k] + 1] if sign > 0
                                             else words[starts[k] - 1:starts[k] + sizes[k]][::-1] for k in own]))
            inner = i[rows] - starts[text[rows]]
            a = inner + length[rows] if sign > 0 else sizes[text[rows]] - inner + length[rows] - q[rows]
            a = begin[text[rows]] + a
            for cut in range(0, len(rows), PAIRS):
                part = slice(cut, cut + PAIRS)
                length[rows[part]] += lce(a[part], a[part] + q[rows[part]])
        size = ahead + back + q
        whole = size >= np.maximum(least, 2 * q)
        runs = [np.concatenate([x, y[whole]]) for x, y in zip(runs, (text, i - back, size, q))]
        order = np.lexsort([runs[3], runs[2], runs[1], runs[0]])
        runs = [x[order] for x in runs]
        first = np.ones(len(order), bool)        # the smallest period of each stretch
        first[1:] = (runs[0][1:] != runs[0][:-1]) | (runs[1][1:] != runs[1][:-1]) | (runs[2][1:] != runs[2][:-1])
        runs = [x[first] for x in runs]
    text, start, size, q = runs
    start = start - starts[text] if len(text) else start
    order = np.lexsort([q, start, text])
    return text[order], start[order], size[order], q[order]


def looped(n: int, h: int) -> np.ndarray | None:
    """Places of the words of the tested text: with h % 10 = 0 its tail repeats its first words (see ``repeat_tails``)."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: not those of a run behind its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:-1]) == 0


def periodic_runs(docs: DataFrame, least: int = LEAST, repeat_tails: bool = False, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the longest run (start, length, period, exponent_milli; ties: smallest
    start, then period; NULLs without one), runs_sha256 of all runs, collapsed_sha256 of the words left when each
    run keeps one period, and with ``with_text`` those words (collapsed) and all runs (start, length, period).

    ``repeat_tails``: of a document with crc32(doc_id) % 10 = 0 the words from a = g % n on are first replaced by
    word a + (i - a) % p, where g = crc32 // 10 and p = 1 + (n - a) // (3 + g % 8)."""
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string" \
        + ", collapsed string, runs array<struct<start: long, length: long, period: long>>" * with_text
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.string(), pa.list_(run)] * with_text
    names = [x.split()[0] for x in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")] \
        + ["collapsed", "runs"] * with_text

    def chunk(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        text, start, size, period = find_runs([np.fromiter(map(ids.__getitem__, words), np.int64, len(words)) for _, words in held], least)
        cuts = np.searchsorted(text, np.arange(len(held) + 1))
        rows = []
        for k, (doc_id, words) in enumerate(held):
            own = slice(cuts[k], cuts[k + 1])
            runs = list(zip(start[own].tolist(), size[own].tolist(), period[own].tolist()))
            if runs:
                best = min(runs, key=lambda r: (-r[1], r[0], r[2]))
                top = (*best, 1000 * best[1] // best[2])
                words = [words[i] for i in np.flatnonzero(collapsed(len(words), runs))]
            else:
                top = (None,) * 4
            left = b" ".join(words)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            row = (doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
            rows.append(row + (left.decode(), [dict(zip(("start", "length", "period"), r)) for r in runs]) if with_text else row)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = raw.split()                       # at ASCII white space, which is [\x20\x09-\x0D]
                at = looped(len(words), h) if repeat_tails else None
                held.append((doc_id, words if at is None else [words[i] for i in at]))
                size += len(raw) + 64
                if size >= CHUNK_BYTES:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("_h"), "text").mapInArrow(detect, schema)


def document_runs(docs: DataFrame) -> DataFrame:
    """The registered query: runs of at least 12 words of every text, tails repeated as stated."""
    return periodic_runs(docs, LEAST, repeat_tails=True)
