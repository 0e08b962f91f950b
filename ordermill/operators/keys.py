"""Dense surrogate keys without a global window."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_KEY


def assign_dense_keys(df: DataFrame, natural_key: str, key: str,
                      start: int = 1, hex_digits: int = 2) -> DataFrame:
    """Number distinct natural keys ``start, start+1, ...`` without gaps.

    Keys are spread over ``16**hex_digits`` buckets by their hash and numbered
    inside each; a bucket starts where the counts of the lower ones end. Every
    number depends on the data alone, so a recomputed task yields the same
    keys. The offset table has at most 16**hex_digits rows, which bounds both
    the one-task running sum and the broadcast.
    """
    bucketed = df.withColumn(
        "_bucket", F.left(F.md5(F.col(natural_key).cast("string")), F.lit(hex_digits)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    return (
        bucketed.withColumn("_pos", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (F.col("_offset") + F.col("_pos") + F.lit(start - 1)).cast("long"))
        .drop("_bucket", "_offset", "_pos")
        .select(key, *df.columns)
    )


def extend_keys(existing: DataFrame | None, merged: DataFrame, natural_key: str,
                key: str, top: int | None = None) -> DataFrame:
    """Keys for the rows of ``merged`` whose key is still NULL, from max+1 on.

    The reserved unknown member does not count towards the maximum. ``top``: the
    maximum where the caller knows it, so that ``existing`` need not be read.
    """
    if top is None:
        top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
    fresh = assign_dense_keys(
        merged.filter(F.col(key).isNull()).drop(key), natural_key, key,
        max(top, UNKNOWN_KEY + 1) + 1)
    return merged.filter(F.col(key).isNotNull()).unionByName(fresh)
