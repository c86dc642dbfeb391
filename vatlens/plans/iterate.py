"""Checkpointed driver loop for iterative graph jobs.

Each round is a lazy DataFrame step; the new state is checkpointed into the
session's reliable checkpoint folder (``spark.checkpoint.dir`` on a cluster)
so the plan does not grow with the round number and a lost executor only
recomputes the current round. The only data that reaches the driver is a
per-round count used as the stop rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from vatlens.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and cut its lineage.

    The frame is persisted first: writing a reliable checkpoint runs a second
    job over the data, which then reads the cached blocks instead of
    recomputing the plan. The checkpointed frame keeps the output
    partitioning, so a table hash-partitioned on a join key before the cut
    is not shuffled again by later joins on that key. The cache is dropped
    once the checkpoint files exist (they survive executor loss; the cache
    does not need to).
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def together(*steps: Callable):
    """Results of steps that do not need each other. Each starts its Spark jobs from a thread of its own, so that
    one's driver work and small jobs do not leave the executors idle."""
    inherit = inheritable_thread_target(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inherit(s)) for s in steps]]


class Beside:
    """A thread whose Spark jobs run beside those of the thread that asks for them, one step after the other."""

    def __init__(self):
        self._pool = ThreadPoolExecutor(1)

    def start(self, step: Callable) -> Future:
        session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        return self._pool.submit(inheritable_thread_target(session)(step))

    def end(self) -> None:
        """Steps that did not begin are left out."""
        self._pool.shutdown(cancel_futures=True)


#: Spark's setting that removes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HOLDERS: list[str | None] = []
_HOLD = Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is planned meanwhile removes its shuffle files once it has run: tables are written and read back, so
    nothing reads them again. It changes no plan and no result. Several threads may hold it; the last one
    puts the session's own setting back."""
    with _HOLD:
        _HOLDERS.append(_HOLDERS[0] if _HOLDERS else spark.conf.get(CLEANUP, None))
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _HOLD:
            before = _HOLDERS.pop()
            if not _HOLDERS:
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


#: Rows of one partition of a reused table (some 100 to 200 MB).
PARTITION_ROWS = 4_000_000


def scratch_path(spark, name: str) -> str:
    """A new path in the shared checkpoint folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vatlens-{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """``df`` written once to the shared folder as parquet and read back: a leaf like ``cut``'s for tables that are
    large and read by columns. There is no cache to fill first and no second job, and readers prune and filter."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._vatlens_table = (None, path)
    return out


def bucketed(df: DataFrame, keys: list[str], buckets: int, period: str | None = None, placed: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder, hash-bucketed on ``keys`` (one file a bucket), and in folders by
    ``period`` if given. Joins and aggregates on ``keys`` read it without a shuffle; the session's settings
    are not touched, so whatever is planned meanwhile keeps AQE. ``placed``: the rows of ``df`` already lie by
    these buckets (a join with such a table), so they are written where they are."""
    spark = df.sparkSession
    name, path = f"vatlens_{uuid.uuid4().hex}", scratch_path(spark, "table")
    writer = (df if placed else df.repartition(buckets, *keys)).write.bucketBy(buckets, *keys).option("path", path).format("parquet")
    (writer.partitionBy(period) if period else writer).saveAsTable(name)
    out = spark.table(name)
    out._vatlens_table = (name, path)
    return out


def remove(spark, paths: list[str]) -> None:
    """Delete folders of tables that nothing reads any more."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(df: DataFrame) -> None:
    """Remove a ``bucketed`` or ``kept`` table that nothing reads any more."""
    name, path = getattr(df, "_vatlens_table", (None, None))
    if name:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        remove(df.sparkSession, [path])


def bucket_count(df: DataFrame, rows: int) -> int:
    """Buckets of a reused table: ``PARTITION_ROWS`` rows each, ``spark.sql.shuffle.partitions`` at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def cut_partitioned(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """``cut`` of ``df`` hash-partitioned on ``keys`` that *advertises* that partitioning.

    For a large table reused by every round of a loop (edges, ownership mesh,
    declarations): later joins on ``keys`` then shuffle only the other side.
    A checkpoint does not keep it under AQE (its plan is adaptive and reports an unknown
    partitioning), so the table is written in buckets. ``df`` itself is computed under AQE
    (runtime join choice, skew splits) into the cache; the number of buckets follows its rows
    (see ``bucket_count``) unless given, and the loop's join sides line up without coalescing.
    """
    base = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = bucketed(base, list(keys), partitions or bucket_count(df, base.count()))
    base.unpersist()
    return out


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach aggregate metrics that are collected by the job that writes the
    round (no extra job); read them with ``obs.get`` after the write."""
    obs = Observation()
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


@dataclass
class LoopTrace:
    rounds_run: int = 0
    changed: list[int] = field(default_factory=list)
