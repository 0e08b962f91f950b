"""Incremental extraction above a high-water mark."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import instant


def placed() -> Column:
    return F.col("order_purchase_timestamp")


def extract_orders(orders: DataFrame, mark: dt.datetime,
                   max_ts: dt.datetime | None = None, inclusive: bool = False,
                   lookback: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Orders placed after ``mark``, optionally up to ``max_ts``.

    The mark is on purchase time with a strict comparison: a row arriving late
    at or below it is not seen again. ``lookback`` lowers the mark to re-read a
    tail; the key merge downstream absorbs the repetition.
    """
    out = orders.filter(placed() > instant(mark - lookback))
    if max_ts is not None:
        bound = instant(max_ts)
        out = out.filter(placed() <= bound if inclusive else placed() < bound)
    return out


def extract_children(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows that belong to the parents of this run."""
    return children.join(parents.select(key), key, "left_semi")


def next_mark(extracted: DataFrame) -> DataFrame:
    """Highest purchase time of the run, NULL if it extracted nothing."""
    return extracted.agg(F.max("order_purchase_timestamp").alias("watermark_value"),
                         F.count("*").alias("rows"))


def with_lineage(df: DataFrame, run_id: int, extracted_at: dt.datetime) -> DataFrame:
    return df.withColumns({
        "_extracted_at": instant(extracted_at),
        "_run_id": F.lit(run_id).cast("long")})


def batch_split(orders: DataFrame, cutoff: str) -> DataFrame:
    """Size and date range of the arrival batches around a cutoff."""
    label = F.when(placed() < F.lit(cutoff).cast("timestamp_ntz"), "batch 1").otherwise(
        "batch 2")
    return orders.groupBy(label.alias("batch")).agg(
        F.count("*").alias("orders"), F.to_date(F.min(placed())).alias("first_day"),
        F.to_date(F.max(placed())).alias("last_day"))
