"""Key-based merges. Both sides carry at most one row per key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_update(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  update: Sequence[str]) -> DataFrame:
    """Insert new keys; for known keys overwrite only the ``update`` columns.

    An incoming NULL overwrites too, so the choice follows whether the row is
    present, not whether the value is.
    """
    keys = list(keys)
    new = incoming.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys],
        F.lit(True).alias("_in"))
    old = target.withColumn("_old", F.lit(True))
    inserted, updated = F.col("_old").isNull(), F.col("_in").isNotNull()
    columns = [
        F.col(c) if c in keys
        else F.when(inserted | updated, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in update
        else F.when(inserted, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        for c in target.columns]
    return old.join(new, keys, "full_outer").select(*columns)


def upsert_ignore(target: DataFrame, incoming: DataFrame,
                  keys: Sequence[str]) -> DataFrame:
    """Insert keys the target lacks, leave all others alone."""
    fresh = incoming.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))
