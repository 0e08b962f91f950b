"""Row choice within a key.

All forms keep one row by ``row_number() = 1``. Catalyst turns that into a
group limit that already runs before the shuffle, so a key with very many
copies sends one row per map task, not all of them. The order must be total:
the choice then does not depend on how rows arrive.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """First row of each key; ties on ``order`` fall to the remaining columns."""
    given = [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in named]
    return _one_row(df, keys, given + rest)


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   version: str = "_extracted_at") -> DataFrame:
    """Most recently extracted row of each key, ties broken by every column."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return _one_row(df, keys, [F.desc_nulls_last(c) for c in [version, *rest]])


def drop_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove surplus rows of a key when all its rows are identical."""
    return df.dropDuplicates(list(keys))


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows, distinct keys and surplus rows.

    Counted per key first, so the distinct count is a plain sum and keys with
    a NULL part still count.
    """
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("duplicate_rows"),
    )
