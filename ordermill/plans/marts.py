"""The three marts. Each is partitioned by year and month when written."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import mean, month_offset, month_start, pct
from ..operators.windows import rolling_rows

#: Attributes of the enriched fact that each mart needs.
REVENUE_NEEDS = ("category", "customer_state")
DELIVERY_NEEDS = ("customer_state", "seller_id", "seller_state")
COHORT_NEEDS = ("customer_unique_id",)


def sold(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_status") != "canceled")


def daily_sales(fact: DataFrame) -> DataFrame:
    """Revenue, orders and items of each day, category and state that sold something.

    An order is first summed up to one row per group, so orders and items are
    plain counts of those rows.
    """
    group = ["order_date", "year", "month", *REVENUE_NEEDS]
    exact = dict(sold(fact).agg(F.sum("price").alias("s")).dtypes)["s"]
    orders = sold(fact).groupBy(*group, "order_id").agg(
        F.sum("price").alias("paid"), F.count(F.lit(1)).alias("n"))
    return orders.groupBy(*group).agg(
        F.sum("paid").cast(exact).alias("revenue"), F.count(F.lit(1)).alias("orders"),
        F.sum("n").alias("items"))


def revenue_daily(fact: DataFrame, money: str = "double") -> DataFrame:
    """Daily sales with the rolling average over seven sales days.

    The window sees daily rows: its partitions are bounded by the calendar.
    ``money`` is the stored type of the revenue, double or decimal.
    """
    days = daily_sales(fact)
    exact = dict(days.dtypes)["revenue"]
    days = rolling_rows(days, list(REVENUE_NEEDS), "order_date", "revenue")
    return days.withColumn("revenue", F.col("revenue").cast(
        exact if money == "decimal" else "double"))


def delivery_performance(fact: DataFrame, by_seller: bool = True) -> DataFrame:
    """Delivered items of a month and state, and of a seller unless told not to."""
    arrived = fact.filter("order_status = 'delivered' and delivery_days is not null")
    n, late = F.count(F.lit(1)), F.count_if("is_late")
    wanted = {"delivered_items": n, "late_items": late, "late_pct": pct(late, n)}
    wanted |= {f"avg_{name}": mean(F.col(column), 1) for name, column in (
        ("delivery_days", "delivery_days"), ("days_vs_promise", "days_vs_estimate"))}
    if not by_seller:
        del wanted["late_items"]
    return arrived.groupBy(
        "year", "month", *(DELIVERY_NEEDS if by_seller else DELIVERY_NEEDS[:1])
    ).agg(*[value.alias(name) for name, value in wanted.items()])


def person_months(fact: DataFrame) -> DataFrame:
    """Number ``n`` of orders of each person and month (an order has one date, so
    these add up)."""
    active = sold(fact).select(*COHORT_NEEDS, "order_id", month_start(
        F.col("order_date")).alias("active_month"))
    return active.distinct().groupBy(*COHORT_NEEDS, "active_month").agg(
        F.count(F.lit(1)).alias("n"))


def cohort_counts(active: DataFrame, last_offset: int = 3, by: Sequence[str] = ()
                  ) -> DataFrame:
    """Customers and orders per cohort, the month of a person's first order, and
    offset; ``by`` are columns that follow from the person. Persons are apart, so
    the counts of disjoint sets of persons add up."""
    joined = F.min("active_month").over(Window.partitionBy(*COHORT_NEEDS))
    return (active.select(*by, "n", "active_month", joined.alias("cohort_month"))
            .withColumn("month_offset", month_offset(F.col("active_month"),
                                                     F.col("cohort_month")))
            .filter(F.col("month_offset") <= last_offset)
            .groupBy(*by, "cohort_month", "month_offset")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("orders")))


def with_retention(counts: DataFrame) -> DataFrame:
    """Cohort sizes and retention: a window over a row per cohort and offset."""
    everyone = F.max(F.when(F.col("month_offset") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month"))
    return counts.withColumn("cohort_size", everyone).select(
        "*", pct(F.col("customers"), F.col("cohort_size")).alias("retention_pct"),
        F.year("cohort_month").alias("year"), F.month("cohort_month").alias("month"))


def customer_cohorts(fact: DataFrame, last_offset: int = 3) -> DataFrame:
    """Retention by the month of the first order. The fact is read once: it shrinks
    to a row per person and month, and then to a row per cohort and offset."""
    return with_retention(cohort_counts(person_months(fact), last_offset))


def full_window_sample(mart: DataFrame, category: str, state: str,
                       rows: int = 7) -> DataFrame:
    """Daily rows of one category and state whose rolling window is full."""
    return mart.filter(
        (F.col("category") == category) & (F.col("customer_state") == state)
        & (F.col("days_in_window") == rows)
    ).select("order_date", "revenue", "revenue_7d_avg", "orders")
