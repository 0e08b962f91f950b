"""raw -> staging: clean, standardise, derive, keep the latest version.

Each function returns (accepted, rejected). Rejected rows are kept apart for
the run log instead of vanishing in a filter.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_code, clean_place, is_late
from .dedup import latest_per_key

CUSTOMER_UPDATES = ["customer_unique_id", "zip_code_prefix", "city", "state"]
ORDER_UPDATES = ["order_status", "order_approved_at", "order_delivered_carrier_date",
                 "order_delivered_customer_date", "delivery_days",
                 "days_vs_estimate", "is_late"]
ORDER_UPDATES_SLIM = [c for c in ORDER_UPDATES
                      if c not in ("order_approved_at", "order_delivered_carrier_date")]
ITEM_UPDATES = ["product_id", "seller_id", "shipping_limit_date", "price",
                "freight_value"]


def _all(*columns: str) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def accepted(table: str) -> Column:
    """Whether a raw row is staged; a NULL verdict rejects, like a WHERE clause would."""
    valid = {"customers": lambda: _all("customer_id"),
             "orders": lambda: _all("order_id", "order_purchase_timestamp",
                                    "order_estimated_delivery_date"),
             "order_items": lambda: _all("order_id", "order_item_id")
             & (F.col("price") >= 0) & (F.col("freight_value") >= 0)}[table]()
    return F.coalesce(valid, F.lit(False))


def _split(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    return raw.filter(accepted(table)), raw.filter(~accepted(table))


def _latest(good: DataFrame, keys: list[str], version: str | None) -> DataFrame:
    """The row staged of each key; with ``version``, its time of extraction, the latest
    one of the key, stays under that name."""
    latest = latest_per_key(good, keys)
    return (latest.withColumnRenamed("_extracted_at", version) if version
            else latest.drop("_extracted_at"))


def stage_customers(raw: DataFrame, version: str | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    good, bad = _split(raw, "customers")
    cleaned = good.select(
        "customer_id", "customer_unique_id",
        F.trim("customer_zip_code_prefix").alias("zip_code_prefix"),
        clean_place(F.col("customer_city")).alias("city"),
        clean_code(F.col("customer_state")).alias("state"),
        "_extracted_at")
    return _latest(cleaned, ["customer_id"], version), bad


def stage_orders(raw: DataFrame, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    good, bad = _split(raw, "orders")
    delivered = F.col("order_delivered_customer_date")
    latest = _latest(good, ["order_id"], version)
    return latest.withColumns({
        "order_status": F.lower(F.trim("order_status")),
        "delivery_days": F.datediff(delivered, "order_purchase_timestamp"),
        "days_vs_estimate": F.datediff(delivered, "order_estimated_delivery_date"),
        "is_late": is_late(delivered, F.col("order_estimated_delivery_date")),
    }), bad


def stage_items(raw: DataFrame, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    good, bad = _split(raw, "order_items")
    return _latest(good, ["order_id", "order_item_id"], version), bad
