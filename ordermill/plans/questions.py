"""The ten analytical questions on the source tables.

Range filters stay on the raw timestamp so they reach the Parquet scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import mean, month_offset, month_start, pct, ratio
from ..operators.dedup import drop_copies, duplicate_summary
from ..operators.dimensions import category
from ..operators.joins import count_children
from ..operators.windows import growth, running_total, top_n

def placed() -> Column:
    return F.col("order_purchase_timestamp")


def month() -> Column:
    return month_start(placed()).alias("month")


def not_canceled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") != "canceled")


def placed_between(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Half-open range on the purchase time."""
    return orders.filter((placed() >= F.lit(start).cast("timestamp_ntz"))
                         & (placed() < F.lit(end).cast("timestamp_ntz")))


def monthly_revenue(orders, items, start: str, end: str) -> DataFrame:
    """Q1. Revenue and orders per month.

    The distinct count reuses the join's partitioning by order. Where one order
    is hot, AQE splits its partition and adds the shuffle (see session.py).
    """
    scoped = not_canceled(placed_between(orders, start, end)).select("order_id", month())
    return (scoped.join(items.select("order_id", "price"), "order_id")
            .groupBy("month")
            .agg(F.sum("price").alias("revenue"),
                 F.countDistinct("order_id").alias("orders")))


def revenue_growth(orders, items, start: str, end: str) -> DataFrame:
    """Q2. Month-over-month growth."""
    return growth(monthly_revenue(orders, items, start, end), "month", "revenue").select(
        "month", "revenue", "prev_revenue", "growth_pct")


def category_revenue_by_state(orders, items, customers, products, translation,
                              start: str, end: str) -> DataFrame:
    named = products.join(translation, "product_category_name", "left").select(
        "product_id", category().alias("category"))
    scoped = not_canceled(placed_between(orders, start, end)).select(
        "order_id", "customer_id")
    where = scoped.join(customers.select(
        "customer_id", F.col("customer_state").alias("state")), "customer_id")
    return (items.select("order_id", "product_id", "price")
            .join(where, "order_id").join(named, "product_id")
            .groupBy("state", "category")
            .agg(F.sum("price").alias("revenue"),
                 F.countDistinct("order_id").alias("orders")))


def top_categories_by_state(orders, items, customers, products, translation,
                            start: str, end: str, n: int = 3) -> DataFrame:
    """Q3. Best n categories of each customer state."""
    return top_n(
        category_revenue_by_state(orders, items, customers, products, translation,
                                  start, end),
        ["state"], [F.desc("revenue")], n,
    ).select("state", "rnk", "category", "revenue", "orders")


def running_total_of_top_sellers(orders, items, k: int = 5) -> DataFrame:
    """Q4. Monthly running total of the k largest sellers (ties: lower id).

    The limit proves the top list small enough to broadcast.
    """
    monthly = (not_canceled(orders).select("order_id", month())
               .join(items.select("order_id", "seller_id", "price"), "order_id")
               .groupBy("seller_id", "month").agg(F.sum("price").alias("revenue")))
    top = (monthly.groupBy("seller_id").agg(F.sum("revenue").alias("total"))
           .orderBy(F.desc("total"), "seller_id").limit(k).select("seller_id"))
    return running_total(monthly.join(F.broadcast(top), "seller_id"),
                         ["seller_id"], "month", "revenue")


def delivery_by_state(orders, customers) -> DataFrame:
    """Q5. Actual against promised delivery time."""
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    done = orders.filter((F.col("order_status") == "delivered") & delivered.isNotNull())
    return (
        done.select("customer_id",
                    F.datediff(delivered, placed()).alias("actual"),
                    F.datediff(promised, placed()).alias("promised"),
                    F.datediff(delivered, promised).alias("over"),
                    (delivered > promised).alias("late"))
        .join(customers.select("customer_id", F.col("customer_state").alias("state")),
              "customer_id")
        .groupBy("state")
        .agg(F.count("*").alias("delivered_orders"),
             mean(F.col("actual"), 1).alias("avg_actual_days"),
             mean(F.col("promised"), 1).alias("avg_promised_days"),
             mean(F.col("over"), 1).alias("avg_days_vs_promise"),
             pct(F.count_if("late"), F.count("*")).alias("late_pct")))


def repeat_rate(orders, customers) -> DataFrame:
    """Q6. Share of people with more than one order. An order has one row
    here, so counting rows per person counts distinct orders."""
    per_person = (
        not_canceled(orders).select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id").agg(F.countDistinct("order_id").alias("orders")))
    return per_person.agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        pct(F.count_if(F.col("orders") > 1), F.count("*")).alias("repeat_rate_pct"),
        F.max("orders").alias("most_orders_by_one_customer"),
        ratio(F.sum("orders"), F.count("*"), 3).alias("avg_orders_per_customer"))


def repeat_rate_by_order_id(orders) -> DataFrame:
    """Q6b. The same by the order-level customer id: the documented mistake."""
    per_id = not_canceled(orders).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"))
    return per_id.agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        pct(F.count_if(F.col("orders") > 1), F.count("*")).alias("repeat_rate_pct"))


def active_months(orders, customers) -> DataFrame:
    """Distinct (person, month) with an order, and the person's first month.

    Deduplicated before any window or count: a person has at most one row per
    month, whatever number of orders they placed.
    """
    active = (not_canceled(orders).select("customer_id", month())
              .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
              .select("customer_unique_id", "month").distinct())
    first = F.min("month").over(Window.partitionBy("customer_unique_id"))
    return active.withColumn("cohort_month", first).withColumn(
        "month_offset", month_offset(F.col("month"), F.col("cohort_month")))


def cohort_retention(orders, customers) -> DataFrame:
    """Q7. Cohort size and returning customers of months 1 to 3.

    Rows are distinct per person and month, so conditional counts replace
    several distinct counts and their row multiplication.
    """
    def at(k: int):
        return F.count_if(F.col("month_offset") == k)
    counts = active_months(orders, customers).groupBy("cohort_month").agg(
        at(0).alias("cohort_size"),
        *[at(k).alias(f"month_{k}") for k in (1, 2, 3)])
    return counts.select("*", *[
        pct(F.col(f"month_{k}"), F.col("cohort_size")).alias(f"m{k}_pct")
        for k in (1, 2, 3)])


def orders_without_payment(orders, payments, items) -> DataFrame:
    """Q8. Orders lacking a payment, with their number of items."""
    unpaid = orders.select("order_id", "order_status", "order_purchase_timestamp").join(
        payments.select("order_id").distinct(), "order_id", "left_anti")
    return count_children(unpaid, items.select("order_id"), ["order_id"], "items")


def orders_without_payment_count(orders, payments) -> DataFrame:
    """Q8b. Only the number of them, as a left join with a NULL test."""
    paid = payments.select(F.col("order_id").alias("paid_id")).distinct()
    return (orders.join(paid, F.col("order_id") == F.col("paid_id"), "left")
            .filter(F.col("paid_id").isNull())
            .agg(F.count("*").alias("orders_without_payment")))


def dedup_report(rows: DataFrame, key: str, copies: DataFrame) -> DataFrame:
    """Q9. Counts before and after removing injected copies."""
    doubled = rows.unionByName(copies)
    before = duplicate_summary(doubled, [key]).withColumn("stage", F.lit("before"))
    after = duplicate_summary(drop_copies(doubled, [key]), [key]).withColumn(
        "stage", F.lit("after"))
    return before.unionByName(after).select(
        "stage", "total_rows", "distinct_keys", "duplicate_rows")


def city_revenue(orders, items, customers, city: str) -> DataFrame:
    """Q10. Items and revenue of one city. The city filter runs in the customer
    scan, so only that city's orders meet the items."""
    there = customers.filter(F.col("customer_city") == city).select("customer_id")
    theirs = not_canceled(orders).select("order_id", "customer_id").join(
        there, "customer_id").select("order_id")
    return items.select("order_id", "price").join(theirs, "order_id").agg(
        F.count("*").alias("items"), F.sum("price").alias("revenue"))
