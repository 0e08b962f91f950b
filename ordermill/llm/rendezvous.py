"""Sharding by rendezvous hashing of record keys over weighted shards.

Each (key, shard) pair has a pseudo-random number u in (0, 1) of its own; a
record goes to the shard with the least -ln(u) / weight. A shard then receives
records in proportion to its weight, and the choice between two shards never
depends on a third: one more shard takes records only into itself, and moves
only those it takes.

Nulls: a null key hashes as the text ``null``; a null text has no bytes (size 1).
Repeated rows stay apart and get slots of their own. An empty table gives an
empty result. Columns that are not named here are ignored by ``with_slots``
and kept by ``with_shard``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = "shards"
#: Records that one numbering task gets, on average.
BUCKET_ROWS = 1 << 16


def hash52(*parts: Column) -> Column:
    """The first 52 bits of the MD5 of the joined parts, as a long."""
    digest = F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("null"))
                                      for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard 0 to len(weights) - 1 of a key; ties go to the lower shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    costs = []
    for shard, weight in enumerate(weights):
        u = (hash52(F.lit(SALT), key, F.lit(shard)) + F.lit(0.5)) / F.lit(2.0 ** 52)
        costs.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"),
                              F.lit(shard).alias("shard")))
    return F.array_min(F.array(*costs))["shard"]


def with_shard(df: DataFrame, key: str, weights: Sequence[float],
               into: str = "shard") -> DataFrame:
    return df.withColumn(into, shard_of(F.col(key), weights))


def with_slots(df: DataFrame, shard: str, key: Sequence[str],
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per record with ``shard``, ``key`` columns and its ``slot``.

    Slots of a shard run from 0 without gaps, by hash bucket and then by key.
    Equal records are counted before the shuffle and spread out at the end, so
    that a key with very many copies costs one row per task; a bucket holds
    about ``bucket_rows`` distinct records however large a shard is.
    """
    cols = [shard, *key]
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("_total") / bucket_rows))
    counted = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
               .join(F.broadcast(total))  # one row
               .withColumn("_bucket", hash52(F.lit("slot"), *map(F.col, key)) % buckets)
               .drop("_total"))
    within = Window.partitionBy(shard, "_bucket").orderBy(*key)
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = (counted.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_size"))
             .select(shard, "_bucket",
                     F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base")))
    return (counted
            .withColumn("_end", F.sum("_n").over(within))
            .join(sizes, [shard, "_bucket"])
            .select(*cols, F.explode(F.sequence(
                F.col("_base") + F.col("_end") - F.col("_n"),
                F.col("_base") + F.col("_end") - 1)).alias("slot")))
