"""Joins the star schema needs beyond a plain equi-join."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_KEY

# Rows up to which a side may be hinted; narrow keys and labels, a few megabytes.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the side has at most ``max_rows`` rows.

    The check reads no more than that many rows. Beyond the bound the frame
    comes back unhinted and Spark shuffles both sides, with AQE splitting a
    skewed partition.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def point_in_time(facts: DataFrame, versions: DataFrame, key: str,
                  at: Column) -> DataFrame:
    """Join each fact to the version valid on its date: key equality plus the
    half-open range. Hash-partitioned on the key; the range is a residual."""
    v = versions.withColumnRenamed(key, "_vkey")
    return facts.join(
        v, (F.col(key) == F.col("_vkey"))
        & (at >= F.col("valid_from")) & (at < F.col("valid_to"))).drop("_vkey")


def as_of(facts: DataFrame, versions: DataFrame, key: str, day: str, value: str
          ) -> DataFrame:
    """``facts`` with the ``value`` of the version of their key valid on their day
    (``valid_from`` to before ``valid_to``); facts without one go. Versions of a key
    don't overlap.

    The days on which a key has facts are found first, counted together before the
    shuffle; one sort per key of these days and of the versions' first days carries
    the last version on. A group there is bounded by the calendar and the key's
    versions, however many facts a key has, and facts never meet versions that
    don't hold on their day. The facts then look up key and day by an equi-join.
    """
    days = facts.select(F.col(key), F.col(day).alias("_at")).distinct()
    found = F.struct(value, "valid_to")
    events = days.select(key, "_at", F.lit(None).cast(
        versions.select(found.alias("v")).schema["v"].dataType).alias("_version"),
        F.lit(1).alias("_kind")).unionByName(versions.select(
            key, F.col("valid_from").alias("_at"), found.alias("_version"),
            F.lit(0).alias("_kind")))
    order = Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    valid = (events.withColumn("_version", F.last("_version", ignorenulls=True).over(order))
             .filter((F.col("_kind") == 1) & (F.col("_at") < F.col("_version.valid_to")))
             .select(F.col(key).alias("_key"), "_at", F.col(f"_version.{value}").alias(value)))
    return facts.join(valid, (F.col(key) == F.col("_key"))
                      & (F.col(day) == F.col("_at"))).drop("_key", "_at")


def lookup_or_unknown(facts: DataFrame, dim: DataFrame, on: str,
                      key: str, unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Surrogate key of a dimension row, the unknown member where none matches."""
    return (facts.join(dim.select(on, key), on, "left")
            .withColumn(key, F.coalesce(F.col(key), F.lit(unknown).cast("long"))))


def missing_in_any(facts: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is absent from at least one dimension.

    Each dimension's key is unique, so a left join against the bare keys does
    not multiply rows and one pass over the facts serves all dimensions.
    """
    out, missing = facts, F.lit(False)
    for key, dim in dims.items():
        seen = dim.select(F.col(key).alias(f"_has_{key}")).distinct()
        out = out.join(seen, F.col(key) == F.col(f"_has_{key}"), "left")
        missing = missing | F.col(f"_has_{key}").isNull()
    return out.filter(missing).select(*facts.columns)


def count_children(parents: DataFrame, children: DataFrame, on: Sequence[str],
                   name: str) -> DataFrame:
    """Children per parent, 0 where there are none; children are counted
    before the join, so parents never multiply."""
    n = children.groupBy(*on).agg(F.count("*").alias(name))
    return (parents.join(n, list(on), "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))
