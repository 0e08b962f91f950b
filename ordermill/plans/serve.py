"""The business questions answered from the marts alone.

Order counts summed over mart rows are not exact: an order with items of two
categories counts twice. The columns keep that meaning.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import month_start, pct, ratio
from ..operators.windows import growth, share_of_total


def _money(name: str):
    """Stored as double; summed exactly."""
    return F.sum(F.col(name).cast("decimal(20,2)"))


def revenue_by(revenue_mart: DataFrame, group: str, k: int = 10) -> DataFrame:
    """Top k groups by revenue and their share."""
    grouped = revenue_mart.groupBy(group).agg(
        _money("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return (share_of_total(grouped, "revenue")
            .orderBy(F.desc("revenue"), group).limit(k))


def revenue_trend(revenue_mart: DataFrame, last: int = 12) -> DataFrame:
    """The last months, growth computed before the cut."""
    monthly = revenue_mart.groupBy(month_start(F.col("order_date")).alias("month")).agg(
        _money("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return growth(monthly, "month", "revenue").orderBy(F.desc("month")).limit(last)


def late_by_state(delivery_mart: DataFrame, k: int = 10) -> DataFrame:
    """Late share weighted by items; ``avg_days`` is the plain mean of the
    groups' averages, ``weighted_avg_days`` the mean over items."""
    days = F.col("avg_delivery_days").cast("decimal(10,1)")
    n = F.sum("delivered_items")
    return (delivery_mart.groupBy("customer_state")
            .agg(n.alias("items"), F.sum("late_items").alias("late"),
                 ratio(F.sum(days), F.count("*"), 1).alias("avg_days"),
                 ratio(F.sum(days * F.col("delivered_items")), n, 1)
                 .alias("weighted_avg_days"))
            .withColumn("late_pct", pct(F.col("late"), F.col("items")))
            .orderBy(F.desc("late_pct"), "customer_state").limit(k))


def worst_sellers(delivery_mart: DataFrame, min_items: int = 100,
                  k: int = 5) -> DataFrame:
    return (delivery_mart.groupBy("seller_id")
            .agg(F.sum("delivered_items").alias("items"),
                 F.sum("late_items").alias("late"))
            .filter(F.col("items") >= min_items)
            .withColumn("late_pct", pct(F.col("late"), F.col("items")))
            .orderBy(F.desc("late_pct"), "seller_id").limit(k))


def first_month_retention(cohort_mart: DataFrame, last: int = 8) -> DataFrame:
    """The latest cohorts one month after their first order."""
    return (cohort_mart.filter("month_offset = 1")
            .select("cohort_month", "cohort_size", "customers", "retention_pct")
            .orderBy(F.desc("cohort_month")).limit(last))


def overall_retention(cohort_mart: DataFrame) -> DataFrame:
    return cohort_mart.filter("month_offset = 1").agg(
        pct(F.sum("customers"), F.sum("cohort_size")).alias("overall_m1_retention_pct"))
