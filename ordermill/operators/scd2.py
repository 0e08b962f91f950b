"""Type 2 history for the customer dimension."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import differs
from ..schemas import FIRST_VALID_FROM, OPEN_END
from .dedup import first_per_key

TRACKED = [("customer_city", "city"), ("customer_state", "state"),
           ("zip_code_prefix", "zip_code_prefix")]


def one_address_per_person(staged_customers: DataFrame) -> DataFrame:
    """A person may own several customer ids with different addresses; the
    lowest id decides, so every run picks the same one."""
    return first_per_key(
        staged_customers.select("customer_unique_id", "customer_id", "city", "state",
                                "zip_code_prefix"),
        ["customer_unique_id"], ["customer_id"]).drop("customer_id")


def scd2_merge(dim: DataFrame, incoming: DataFrame, as_of: dt.date,
               first_valid_from: str = FIRST_VALID_FROM) -> DataFrame:
    """The dimension after applying one address per person on ``as_of``.

    One full outer join of the current rows with the input classifies each
    person (column ``change``); a change yields the closed and the new row
    together. Closed history does not take part in the join. New rows have a
    NULL ``customer_key``. Applying the same input again changes nothing.
    """
    today = F.lit(as_of).cast("date")
    now = incoming.select(
        "customer_unique_id", *[F.col(src).alias(f"_new_{col}") for col, src in TRACKED],
        F.lit(True).alias("_in"))
    current = dim.filter("is_current").withColumn("_known", F.lit(True))
    changed = differs(*[(F.col(col), F.col(f"_new_{col}")) for col, _ in TRACKED])
    change = (F.when(F.col("_in").isNull(), "untouched")
              .when(F.col("_known").isNull(), "new")
              .when(~changed, "unchanged")
              .when(F.col("valid_from") >= today, "corrected")
              .otherwise("versioned"))
    joined = (current.join(now, "customer_unique_id", "full_outer")
              .withColumn("change", change))

    def row(key, attributes, valid_from, valid_to, is_current):
        return F.struct(key.alias("customer_key"), *attributes,
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"),
                        is_current.alias("is_current"))

    no_key = F.lit(None).cast("long")
    open_end = F.lit(OPEN_END).cast("date")
    old = [F.col(col) for col, _ in TRACKED]
    new = [F.col(f"_new_{col}").alias(col) for col, _ in TRACKED]
    true, false = F.lit(True), F.lit(False)
    kept = row(F.col("customer_key"), old, F.col("valid_from"), F.col("valid_to"), true)
    corrected = row(F.col("customer_key"), new, F.col("valid_from"),
                    F.col("valid_to"), true)
    closed = row(F.col("customer_key"), old, F.col("valid_from"), today, false)
    version = row(no_key, new, today, open_end, true)
    first = row(no_key, new, F.lit(first_valid_from).cast("date"), open_end, true)

    rows = (F.when(F.col("change") == "versioned", F.array(closed, version))
            .when(F.col("change") == "corrected", F.array(corrected))
            .when(F.col("change") == "new", F.array(first))
            .otherwise(F.array(kept)))
    merged = joined.select("customer_unique_id", "change", F.inline(rows))
    history = dim.filter("not is_current").withColumn("change", F.lit("history"))
    return history.unionByName(merged).select(*dim.columns, "change")


def change_counts(merged: DataFrame) -> DataFrame:
    """Expired, corrected, versioned and new rows of one merge."""
    def n(condition):
        return F.count_if(condition)
    kind = F.col("change")
    return merged.agg(
        n((kind == "versioned") & ~F.col("is_current")).alias("expired"),
        n(kind == "corrected").alias("corrected"),
        n((kind == "versioned") & F.col("is_current")).alias("versioned"),
        n(kind == "new").alias("new"))
