"""Dimension contents, before surrogate keys."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_key, iso_weekday
from ..schemas import FIRST_VALID_FROM, OPEN_END, UNCATEGORISED, UNKNOWN_KEY
from .dedup import first_per_key

SLIM_DATE = ["date_key", "full_date", "year", "quarter", "month", "month_name",
             "day_of_week", "is_weekend", "month_start"]


def dim_date(bounds: DataFrame, slim: bool = False) -> DataFrame:
    """One row per day between ``lo`` and ``hi`` of the one-row ``bounds``."""
    d = F.col("full_date")
    calendar = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    full = calendar.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"), iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        (iso_weekday(d) >= 6).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"))
    return full.select(*SLIM_DATE) if slim else full


def calendar_bounds(df: DataFrame, day: str | Column) -> DataFrame:
    """First day of the first year to last day of the last year in the data."""
    col = F.col(day) if isinstance(day, str) else day
    return df.agg(F.trunc(F.min(col), "year").alias("lo"),
                  F.date_sub(F.add_months(F.trunc(F.max(col), "year"), 12), 1)
                   .alias("hi"))


def category(english: str = "product_category_name_english",
             portuguese: str = "product_category_name") -> Column:
    return F.coalesce(F.col(english), F.col(portuguese), F.lit(UNCATEGORISED))


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """The translation has one row per category name; Spark broadcasts it by
    its size."""
    return products.join(translation, "product_category_name", "left").select(
        "product_id", F.col("product_category_name").alias("category_pt"),
        category().alias("category_en"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"))


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_city", "seller_state",
                          F.col("seller_zip_code_prefix").alias("zip_code_prefix"))


def modal_place(geolocation: DataFrame) -> DataFrame:
    """Most frequent (city, state) of each zip; ties go to the lower city, then
    state. Observations are counted first, so a hot zip is already small."""
    counted = geolocation.groupBy(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state")).agg(F.count("*").alias("n"))
    return first_per_key(counted, ["zip_code_prefix"],
                         [F.col("n").desc(), F.col("city"), F.col("state")])


def centroid(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates of each zip, summed as decimals: the same value in
    whatever order the rows are added."""
    def mean(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(18,8)")).cast("double") / F.count(c)
    return geolocation.groupBy(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        mean("geolocation_lat").alias("latitude"),
        mean("geolocation_lng").alias("longitude"))


def zip_places(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """One place per zip seen on a customer or a seller (lowest city, state)."""
    both = customers.select(
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"), F.col("customer_state").alias("state"),
    ).unionByName(sellers.select(
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"), F.col("seller_state").alias("state")))
    return first_per_key(both, ["zip_code_prefix"], ["city", "state"])


def dim_geography(geolocation: DataFrame, customers: DataFrame,
                  sellers: DataFrame) -> DataFrame:
    """Modal place and centroid, then zips known only from addresses."""
    surveyed = modal_place(geolocation).drop("n").join(
        centroid(geolocation), "zip_code_prefix")
    rest = zip_places(customers, sellers).join(
        surveyed.select("zip_code_prefix"), "zip_code_prefix", "left_anti")
    return surveyed.unionByName(rest, allowMissingColumns=True)


def unknown_geography(like: DataFrame) -> DataFrame:
    """The reserved member, with the columns of a keyed geography dimension."""
    row = {"geo_key": UNKNOWN_KEY, "zip_code_prefix": "n/a", "city": "(unknown)",
           "state": "XX"}
    return like.sparkSession.createDataFrame(
        [tuple(row.get(c) for c in like.columns)], like.schema)


def dim_customer_initial(customers: DataFrame, orders: DataFrame | None,
                         first_valid_from: str = FIRST_VALID_FROM) -> DataFrame:
    """One open-ended row per person.

    With ``orders`` the address is that of the latest order, otherwise that of
    the lowest customer id.
    """
    people = customers.select(
        "customer_unique_id", "customer_id", "customer_city", "customer_state",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"))
    order: list[str | Column] = ["customer_id"]
    if orders is not None:
        last = orders.groupBy("customer_id").agg(
            F.max("order_purchase_timestamp").alias("_last"))
        people = people.join(last, "customer_id", "left")
        order = [F.desc_nulls_last("_last"), F.col("customer_id")]
    one = first_per_key(people, ["customer_unique_id"], order)
    return one.select(
        "customer_unique_id", "customer_city", "customer_state", "zip_code_prefix",
        F.lit(first_valid_from).cast("date").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
