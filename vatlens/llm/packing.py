"""Operator 3, best-fit packing by the sum-of-squares rule.

A document is its token ids and one closing id. One longer than a sequence is cut
into pieces of the sequence's length, of which the first takes the remainder. Full
pieces are sequences of their own. Each other piece goes where the sum over residual
gaps of the squared number of open bins with that gap becomes smallest; the choice
needs only those counts, not the bins' contents.

The rule is sequential, so the pieces are dealt at random to shards of about
``shard_pieces`` pieces, and each shard is packed by one task, in the order dealt and in
order of falling length, of which the better stays; the
state of a shard is one count per gap. The pieces of the sequences that stay open at
the end of a shard (a few in a hundred) are then taken out and placed once more, in
order of falling length into the smallest gap that holds them. The number of shards
follows the number of pieces.

Ids: those of ``tokenizers`` with the given file and add_special_tokens=False. The
same vocabulary and pattern run several times faster in ``tiktoken``, whose ids are
equal (tests compare them); texts that hold the special token's own string go to
``tokenizers`` itself. NULL texts are empty (one piece of one id). A row is one
document, also if it repeats a doc_id.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import materialise

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Fixed: the special token of the vocabulary.
SPECIAL = "<|endoftext|>"

_encoders: dict[str, object] = {}


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Paths of the tokenizer file and of the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def encoder(files: tuple[str, str]):
    """text -> ids, loaded once per Python worker."""
    if files not in _encoders:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(files[0])
        with open(files[1], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if SPECIAL in text:
                return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
            return np.array(fast.encode_ordinary(text), np.uint32)

        _encoders[files] = encode
    return _encoders[files]


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    if n <= capacity:
        return [n]
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None) -> DataFrame:
    """The pieces of every document."""
    files = files or vocabulary()
    names = [x.split()[0] for x in PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(files)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                start = 0
                for k, n in enumerate(piece_lengths(len(ids), capacity)):
                    rows.append((doc_id, k, start, n, zlib.crc32(ids[start:start + n].tobytes())))
                    start += n
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "piece" else pa.int64()) for c, n in zip(cols, names)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def place(lengths: np.ndarray, capacity: int = CAPACITY, tightest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, placed in the given order; lengths from 1 to ``capacity``.

    By the sum of squares: moving a bin from gap g to g - s changes it by
    2 (N[g - s] - N[g]) + 2; a bin that becomes full leaves the sum, and a new bin
    enters it at capacity - s. Ties go to the smallest gap, a new bin counts as the
    largest. With ``tightest``, the smallest gap that holds the item instead.
    """
    count = np.zeros(capacity + 1, np.int64)        # open bins per gap; gap 0 is never counted
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins = 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        gap = capacity
        if s < capacity:
            there = count[s:capacity]                # gaps s .. capacity - 1
            if tightest:
                k = int((there > 0).argmax())
                gap = s + k if there[k] else capacity
            else:
                change = 2 * (count[:capacity - s] - there) + 2
                change[0] = 1 - 2 * there[0]         # filled up exactly
                change[there == 0] = far
                k = int(change.argmin())
                gap = s + k if change[k] <= 2 * count[capacity - s] + 1 else capacity
        if gap == capacity:
            b = bins
            bins += 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        where[i], offset[i] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return where, offset


def settle(lengths: np.ndarray, order: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of the items placed in ``order`` by the rule, then the open bins once more."""
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    where[order], offset[order] = place(lengths[order], capacity)
    is_open = np.bincount(where, weights=lengths) < capacity
    again = np.flatnonzero(is_open[where])
    again = again[np.argsort(-lengths[again], kind="stable")]
    full = np.cumsum(~is_open) - 1
    second, offset[again] = place(lengths[again], capacity, tightest=True)
    where = full[where]
    where[again] = int((~is_open).sum()) + second
    return where, offset


def pack_shard(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of the items of one shard, in the order given or of falling length,
    whichever leaves fewer bins."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    orders = (np.arange(len(lengths)), np.argsort(-lengths, kind="stable"))
    return min((settle(lengths, order, capacity) for order in orders), key=lambda found: found[0].max())


def pack(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece with its sequence and its place there (``PACKED``)."""
    cut = materialise(pieces(docs, capacity, files).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    def fill(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("_row", kind="stable").sample(frac=1, random_state=len(shard))
        where, shard["offset"] = pack_shard(shard["length"].to_numpy(), capacity)
        shard["sequence_id"] = where * shards + shard["_shard"]
        return shard[[x.split()[0] for x in PACKED.split(", ")]]

    return dealt.groupBy("_shard").applyInPandas(fill, PACKED)
