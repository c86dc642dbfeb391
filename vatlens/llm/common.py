"""Shared helpers of the text operators: shared-folder tables and byte-level word hashing.

Conventions of every operator in this package:

* A NULL text is the empty text; a NULL ``doc_id`` is a value like any other
  (it is the smallest one, and its text form is the empty string).
* Only the named input columns are read, so extra columns of any name pass by
  unseen; internal columns start with an underscore.
* An empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vatlens.session import ensure_checkpoint_dir

#: Fixed: the ASCII letters, for lower-casing A-Z alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed: white space of the word contract, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"

#: Spark's setting that removes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a table that may be broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 100_000
#: Bytes of text that a task handles at once.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: later stages read files that all executors see, so
    the loss of an executor costs only its running tasks. The files are removed
    by ``discard``, or when the driver's JVM ends. The write's own shuffle files go
    when it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vatlens-llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")            # read when the write is planned; it changes no plan and no result
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out._vatlens_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that nothing reads any more: all that was made of them is written."""
    for t in tables:
        spark = t.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._vatlens_path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is a table of at most ``rows`` rows; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text modulo ``n`` (a NULL id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))) % n


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on texts of ASCII alone and is cheaper."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


# --- rows kept by a filtering stage -----------------------------------------------------------

def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that name a document by content: id and MD5 of its text."""
    return [F.col(doc_id).alias("_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_md5")]


def drop_rows(docs: DataFrame, losers: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those whose (id, text) is in ``losers`` (_id, _md5, _all), whole rows.

    ``losers`` has each (id, text) once. With ``_all`` all its rows go, else one of its equal rows stays.
    A table of losers up to the broadcast bound meets the texts where they lie; a larger one
    by a shuffle on the id and digest.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    at = {c: names[i] for i, c in reversed(list(enumerate(docs.columns)))}
    flat = flat.withColumns(dict(zip(("_id", "_md5"), row_key(at["doc_id"], at["text"]))))
    k = small(losers.toDF("_kid", "_kmd5", "_all"))
    met = flat.join(k, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_md5") == F.col("_kmd5")), "left")
    out = met.where("_all is null")
    if not losers.where("not _all").isEmpty():
        out = out.unionByName(met.where("not _all").dropDuplicates(["_id", "_md5"]))
    return out.select(*names).toDF(*docs.columns)


# --- Arrow text columns as byte arrays ---------------------------------------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without copying; NULL rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), raw


def chunked(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each (a longer text alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


_mix1, _mix2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_odd = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _mix1
        h = (h ^ (h >> np.uint64(27))) * _mix2
        return h ^ (h >> np.uint64(31))


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))) * np.uint64(pow(int(_mix2), -1, 1 << 64))
        h = (h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))) * np.uint64(pow(int(_mix1), -1, 1 << 64))
        return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _odd)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n + 1:
        base = 0xD1342543DE82EF95
        with np.errstate(over="ignore"):
            for key, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
                p = np.full(n + 1, b, np.uint64)
                p[0] = 1
                _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of texts, A-Z lower-cased, in reading
    order, and the index of the first word of each text (one more entry than texts).

    The hash of a word is a polynomial in its bytes taken from running sums, so a whole
    chunk of texts is hashed by a few array passes. Equal words have equal hashes;
    different ones collide with probability 2**-64 a pair.
    """
    base = int(offsets[0])
    data = _LOWERED[raw[base:int(offsets[-1])]]
    cuts = offsets - base
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[data]
    first = np.empty(n, bool)
    first[0], first[1:] = True, space[:-1]
    first[cuts[(cuts < n)]] = True
    first &= ~space
    last = np.empty(n, bool)
    last[-1], last[:-1] = True, space[1:]
    inner = cuts[(cuts > 0) & (cuts <= n)]
    last[inner - 1] = True
    last &= ~space
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    span = 1_000_000
    up, down = _power_tables(span)
    with np.errstate(over="ignore"):
        at = 0
        while at < len(starts):  # segments of words, so that tables and sums stay small
            low = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, low + span, "right")))
            high = int(ends[to - 1])
            if high - low > len(up) - 1:
                up, down = _power_tables(high - low)
            sums = np.empty(high - low + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE[data[low:high]] * up[:high - low], out=sums[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _odd)
            at = to
    return out, np.searchsorted(starts, cuts, "left").astype(np.int64)


# --- a filter of hashes seen twice ---------------------------------------------------------------

#: Bits of one piece of a filter.
PIECE = 1 << 16


def cells_hit_twice(texts: DataFrame, hashes: Callable[[pa.Array], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """Packed bits: the cells hit twice or more by the ``hashes`` of a text column; a table of fixed size. Each
    task sends two bytes for a cell that it hits."""
    def emit(cells: np.ndarray) -> pa.RecordBatch:
        """Each cell once, apart those hit twice here, a row a piece."""
        cells = np.sort(cells)
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        times, cells = np.diff(np.append(first, len(cells))), cells[first]
        rows = [[], [], []]
        for mark in (False, True):
            some = cells[times > 1] if mark else cells[times == 1]
            piece = some // PIECE
            cuts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(some) else np.zeros(0, np.int64)
            for low, high in zip(cuts, np.append(cuts[1:], len(some))):
                for column, x in zip(rows, (int(piece[low]), mark, (some[low:high] % PIECE).astype("<u2").tobytes())):
                    column.append(x)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int32(), pa.bool_(), pa.binary()))], names=["piece", "twice", "cells"])

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for s in hashes(batch.column(0)):
                held.append((s % np.uint64(bits)).astype(np.uint32))
                size += len(s)
                if size > 4_000_000:
                    yield emit(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield emit(np.concatenate(held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One piece after the other, as the rows are sorted by it."""
        now, once, more = None, None, None

        def piece_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(more).tobytes()], pa.binary())], names=["piece", "bits"])
        for batch in batches:
            for piece, twice, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if piece != now:
                    if now is not None and more.any():
                        yield piece_of()
                    now, once, more = piece, np.zeros(PIECE, bool), np.zeros(PIECE, bool)
                at = np.frombuffer(raw, "<u2")
                more[at if twice else at[once[at]]] = True
                once[at] = True
        if now is not None and more.any():
            yield piece_of()

    met = materialise(texts.mapInArrow(hit, "piece int, twice boolean, cells binary").repartition("piece").sortWithinPartitions("piece")
                      .mapInArrow(meet, "piece int, bits binary"), "cells")
    out = np.zeros((bits // PIECE, PIECE // 8), np.uint8)
    for row in met.toLocalIterator():                                      # ``bits`` bits in all
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    discard(met)
    return out.reshape(-1)


def is_set(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether the cell of each hash is set."""
    cell = s % np.uint64(len(bits) * 8)
    return (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8))) & 1 == 1


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return h.astype(np.uint64).view(np.int64)


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
