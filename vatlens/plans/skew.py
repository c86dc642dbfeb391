"""Salting for joins against a table that is pre-partitioned and reused.

Loops and hops join a large, reused table (edges, ownership mesh) that is
hash-partitioned once on the join key and checkpointed, so each round
shuffles only the small side. AQE cannot split a skewed partition there
(there is no shuffle on the big side to split), so keys holding many rows
are salted explicitly:

* ``hot_keys`` -- keys with more than ``rows / (2 * partitions)`` rows, with
  the number of salt buckets each needs. At most ``2 * partitions`` keys can
  pass that threshold, so the table has a proven size bound and is broadcast.
* ``salt_big`` -- rows of a hot key get ``_salt = pmod(hash(spread), n)``;
  other rows get 0. The big side is then partitioned on (key, _salt).
* ``salt_small`` -- rows of a hot key are repeated once per bucket.
* ``find_hot_keys`` -- ``hot_keys`` materialised, or ``None`` when no key is
  hot. Then there is no salt at all: both salt functions return their input
  and ``salt_keys`` is just the keys, so the usual case pays no broadcast join
  per round. (A constant ``_salt = 0`` on the small side would be folded out
  of the join keys by the optimizer, and the big side, partitioned on
  (key, _salt), would be shuffled again.)

A key holding a third of all rows is thus spread over every partition; no
row is dropped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.plans.iterate import cut

SALT = "_salt"
NSALT = "_nsalt"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def hot_keys(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """(keys..., _nsalt) for keys holding more than rows / (2 * partitions) rows."""
    p = partitions or shuffle_partitions(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select(F.count(F.lit(1))).scalar()
    threshold = F.greatest(total / (2 * p), F.lit(1.0))
    return (counts.where(F.col("_n") > threshold)
            .select(*keys, F.least(F.lit(p), F.ceil(F.col("_n") / threshold)).cast("int").alias(NSALT)))


def find_hot_keys(df: DataFrame, keys: list[str], partitions: int | None = None,
                  materialise: Callable[[DataFrame], DataFrame] = cut) -> DataFrame | None:
    """``hot_keys`` materialised (a bounded table), or ``None`` when there is none."""
    hot = materialise(hot_keys(df, keys, partitions))
    return hot if hot.count() > 0 else None       # counts the small materialised table


def salt_keys(keys: list[str], hot: DataFrame | None) -> list[str]:
    """Join / partitioning keys of a salted table: ``keys`` plus ``_salt`` when salted."""
    return list(keys) + ([SALT] if hot is not None else [])


def salt_big(df: DataFrame, keys: list[str], hot: DataFrame | None, spread: list[str]) -> DataFrame:
    """Add ``_salt``: a hash bucket of ``spread`` for hot keys, 0 otherwise."""
    if hot is None:
        return df
    j = df.join(F.broadcast(hot), keys, "left")
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.col(NSALT)).cast("int")
    return j.withColumn(SALT, F.when(F.col(NSALT).isNull(), F.lit(0)).otherwise(bucket)).drop(NSALT)


def salt_small(df: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Repeat rows of hot keys once per salt bucket (``_salt`` = 0..n-1); others get 0."""
    if hot is None:
        return df
    j = df.join(F.broadcast(hot), keys, "left")
    buckets = F.when(F.col(NSALT).isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col(NSALT) - 1))
    return j.withColumn(SALT, F.explode(buckets)).drop(NSALT)
