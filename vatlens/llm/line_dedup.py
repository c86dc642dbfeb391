"""Operator 6, line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble.

A text is split at \\n. A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends,
A-Z lower-cased. Keys of at least ``min_chars`` code points that stand in at least
``min_docs`` documents lose all their lines except in the largest doc_id that holds
them; the other lines stay, joined by \\n in their order.

A document is a doc_id: rows that repeat a doc_id count once and share their fate.
A NULL doc_id is the smallest id. A NULL or empty text is one empty line.

Plan: one pass explodes each row into the distinct 128-bit digests of its keys
(digests, never lines, are shuffled); counting combines on the map side; the keys to
drop return to their documents as one list per doc_id; a second pass over the texts
drops their lines by position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import SPACE, materialise

MIN_CHARS, MIN_DOCS = 20, 3


def key_of(line: str, min_chars: int) -> bytes | None:
    """Digest of a line's key; None if the key is too short to count."""
    key = line.strip(SPACE)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, _key) of the keys that count, once per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("_key", pa.binary())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {key_of(x, min_chars) for x in (text.as_py() or "").split("\n")} - {None}
                ids += [doc_id] * len(own)
                keys += own
                if len(keys) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], schema=schema)
                    ids, keys = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(explode, "doc_id long, _key binary")


def lost_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, _lost): the keys whose lines each document loses."""
    held = materialise(line_keys(docs, min_chars), "line-keys")
    # distinct documents per key; a NULL id counts as one document
    per_key = held.groupBy("_key").agg(
        (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("_docs"),
        F.max("doc_id").alias("_last")).where(F.col("_docs") >= min_docs).select("_key", "_last")
    # a table of its own, so that the join can split the documents of a frequent line
    lost = held.join(materialise(per_key, "lost-keys"), "_key").where(~F.col("doc_id").eqNullSafe(F.col("_last")))
    return lost.groupBy("doc_id").agg(F.collect_set("_key").alias("_lost"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               with_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256), and ``kept_text`` if asked, per row of ``docs``."""
    lost = lost_keys(docs, min_chars, min_docs).withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "_lost")
    fields = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept_text", pa.string())] * with_text)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, lost in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text, gone = text.as_py() or "", set(lost.as_py() or ())
                lines = text.split("\n")
                kept = [x for x in lines if key_of(x, min_chars) not in gone] if gone else lines
                out = "\n".join(kept) if gone else text
                rows.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(out.encode()).hexdigest(), out)[:len(schema)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    return joined.mapInArrow(reassemble, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * with_text)


SQL = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
bad AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.doc_id, k.line, k.pos, bad.key IS NOT NULL AND k.doc_id <> bad.last AS gone FROM k LEFT JOIN bad USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
