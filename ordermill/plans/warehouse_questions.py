"""Questions answered on the star schema.

Each question joins the bare fact to just the dimensions it needs: Spark prunes
columns, but it cannot leave out an inner join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mean, pct
from ..operators.windows import growth, share_of_total, top_n

SOLD = "order_status <> 'canceled'"
DELIVERED = "order_status = 'delivered' and delivery_days is not null"


def _revenue():
    return F.sum("price").alias("revenue"), F.countDistinct("order_id").alias("orders")


def monthly_revenue(fact: DataFrame, dim_date: DataFrame, years: list[int]) -> DataFrame:
    days = dim_date.filter(F.col("year").isin(years)).select(
        "date_key", F.col("month_start").alias("month"))
    return fact.filter(SOLD).join(days, "date_key").groupBy("month").agg(*_revenue())


def top_categories(fact, dim_geography, dim_product, dim_date, years: list[int],
                   n: int = 3) -> DataFrame:
    by_state = (
        fact.filter(SOLD)
        .join(dim_date.filter(F.col("year").isin(years)).select("date_key"), "date_key")
        .join(dim_geography.select("geo_key", "state"), "geo_key")
        .join(dim_product.select("product_key", F.col("category_en").alias("category")),
              "product_key")
        .groupBy("state", "category").agg(*_revenue()))
    return top_n(by_state, ["state"], [F.desc("revenue")], n).select(
        "state", "rnk", "category", "revenue", "orders")


def delivery_by_state(fact, dim_geography) -> DataFrame:
    return (fact.filter(DELIVERED)
            .join(dim_geography.select("geo_key", "state"), "geo_key")
            .groupBy("state").agg(*_delivery()))


def _delivery():
    return (F.count("*").alias("delivered_items"),
            mean(F.col("delivery_days"), 1).alias("avg_delivery_days"),
            mean(F.col("days_vs_estimate"), 1).alias("avg_days_vs_promise"),
            pct(F.count_if("is_late"), F.count("*")).alias("late_pct"))


def revenue_cube(fact, dim_date, dim_product, dim_geography, year: int) -> DataFrame:
    """Revenue by month name, category and state of one year."""
    return (fact.join(dim_date.filter(F.col("year") == year)
                      .select("date_key", "month_name"), "date_key")
            .join(dim_product.select("product_key", "category_en"), "product_key")
            .join(dim_geography.select("geo_key", "state"), "geo_key")
            .groupBy("month_name", "category_en", "state")
            .agg(F.sum("price").alias("revenue")))


def revenue_share(fact, dim, key: str, label: str, alias: str, k: int = 10) -> DataFrame:
    """Top k groups by revenue with exact orders and share of the grand total."""
    grouped = (fact.filter(SOLD).join(dim.select(key, F.col(label).alias(alias)), key)
               .groupBy(alias).agg(*_revenue()))
    return share_of_total(grouped, "revenue").orderBy(F.desc("revenue"), alias).limit(k)


def revenue_trend(fact, dim_date) -> DataFrame:
    monthly = (fact.filter(SOLD)
               .join(dim_date.select("date_key", F.col("month_start").alias("month")),
                     "date_key")
               .groupBy("month").agg(*_revenue()))
    return growth(monthly, "month", "revenue").select(
        "month", "revenue", "orders", "growth_pct")


def worst_states(fact, dim_geography, k: int = 10) -> DataFrame:
    return (delivery_by_state(fact, dim_geography)
            .orderBy(F.desc("late_pct"), "state").limit(k))


def worst_sellers(fact, dim_seller, min_items: int = 100, k: int = 10) -> DataFrame:
    """Sellers with enough deliveries to be ranked, by late share."""
    return (fact.filter(DELIVERED)
            .join(dim_seller.select("seller_key", "seller_id", "seller_state"),
                  "seller_key")
            .groupBy("seller_id", "seller_state")
            .agg(F.count("*").alias("delivered_items"),
                 pct(F.count_if("is_late"), F.count("*")).alias("late_pct"),
                 mean(F.col("delivery_days"), 1).alias("avg_delivery_days"))
            .filter(F.col("delivered_items") >= min_items)
            .orderBy(F.desc("late_pct"), "seller_id").limit(k))
