"""The order-data entities, derived from the TPC-H-like test tables.

Columns carry the source tables' names, so every operator runs unchanged on
the real data set. Everything is an expression over the whole table; nothing
is filtered away except where the entity itself means a subset (payments).
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"

# The translated categories; the other part types stay untranslated.
TRANSLATIONS = [("economy", "economy_goods"), ("standard", "standard_goods"),
                ("promo", "promo_goods"), ("large", "large_goods")]

# Status codes of the test tables.
STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}


def _state(nation: str):
    return F.concat(F.lit("N"), F.chr(F.col(nation) + 65))


def _zip(number):
    return F.lpad(number.cast("string"), 5, "0")


class Source:
    """Lazy frames over one directory of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        placed = F.col("o_orderdate")
        status = F.col("o_orderstatus")
        amount = F.floor("o_totalprice").cast("int")
        hours = (F.col("o_orderkey") % 24).cast("int")
        zero = F.lit(0)
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(status == "F", STATUS["F"]).when(status == "O", STATUS["O"])
             .otherwise(STATUS["P"]).alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            F.when(status != "P", placed + F.make_dt_interval(zero, hours))
             .alias("order_approved_at"),
            F.when(status != "P", placed + F.make_dt_interval(1 + amount % 5, hours))
             .alias("order_delivered_carrier_date"),
            F.when((status == "F") & (F.col("o_orderkey") % 29 != 0),
                   placed + F.make_dt_interval(amount % 45, hours))
             .alias("order_delivered_customer_date"),
            (placed + F.make_dt_interval(
                (20 + F.col("o_custkey") % 15).cast("int"), zero))
             .alias("order_estimated_delivery_date"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_quantity").cast(MONEY).alias("freight_value"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Three consecutive customer ids belong to one person."""
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey div 3").alias("customer_unique_id"),
            _zip(F.col("c_nationkey") * 3970 + F.col("c_custkey") % 7 + 1)
             .alias("customer_zip_code_prefix"),
            F.lower("c_mktsegment").alias("customer_city"),
            _state("c_nationkey").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("seller_id"),
            _zip(F.col("s_nationkey") * 3970 + F.col("s_suppkey") % 9 + 1)
             .alias("seller_zip_code_prefix"),
            F.concat(F.lit("town "), F.col("s_suppkey") % 11).alias("seller_city"),
            _state("s_nationkey").alias("seller_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(size != 50, F.lower("p_type")).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (size * 10).alias("product_description_lenght"),
            (size % 6).alias("product_photos_qty"),
            (size * 100).alias("product_weight_g"),
            (size + 10).alias("product_length_cm"),
            (size + 5).alias("product_height_cm"),
            (size + 7).alias("product_width_cm"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """Literal rows: four, by construction."""
        return self.spark.createDataFrame(
            TRANSLATIONS,
            "product_category_name string, product_category_name_english string")

    @cached_property
    def geolocation(self) -> DataFrame:
        """Several observations per zip; city varies within it."""
        return self.table("customer").select(
            _zip(F.col("c_nationkey") * 3970 + F.col("c_custkey") % 7 + 1)
             .alias("geolocation_zip_code_prefix"),
            (F.col("c_acctbal").cast(MONEY) / 100).cast("decimal(12,4)")
             .alias("geolocation_lat"),
            (F.col("c_custkey") % 180).cast("decimal(12,4)").alias("geolocation_lng"),
            F.lower("c_mktsegment").alias("geolocation_city"),
            _state("c_nationkey").alias("geolocation_state"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """A finalised line is a paid line; orders without one lack a payment."""
        flag = F.col("l_returnflag")
        return self.table("lineitem").filter(F.col("l_linestatus") == "F").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.when(flag == "A", "credit_card").when(flag == "N", "boleto")
             .otherwise("voucher").alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            F.col("l_extendedprice").cast(MONEY).alias("payment_value"),
        )

    @cached_property
    def review_texts(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("review_id"),
            F.col("text").alias("review_comment_message"),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        """Customers as they land: padded, mixed case, two versions of each id."""
        dirty = self.customers.select(
            "customer_id", "customer_unique_id",
            F.concat(F.lit(" "), "customer_zip_code_prefix", F.lit(" "))
             .alias("customer_zip_code_prefix"),
            F.concat(F.lit("  "), F.upper("customer_city"), F.lit("   DO  SUL "))
             .alias("customer_city"),
            F.concat(F.lower("customer_state"), F.lit(" ")).alias("customer_state"),
            F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("_extracted_at"),
        )
        later = dirty.select(
            "customer_id", "customer_unique_id", "customer_zip_code_prefix",
            F.concat(F.col("customer_city"), F.lit("NOVO")).alias("customer_city"),
            "customer_state",
            F.lit("2001-02-01 00:00:00").cast("timestamp_ntz").alias("_extracted_at"),
        )
        return dirty.unionByName(later)

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Orders landed twice: first as created, then with their final status."""
        final = self.orders.withColumn(
            "order_status", F.concat(F.lit(" "), F.upper("order_status"), F.lit(" ")))
        first = final.withColumns({
            "order_status": F.lit("CREATED"),
            "order_delivered_customer_date": F.lit(None).cast("timestamp_ntz"),
            "_extracted_at": F.col("order_purchase_timestamp"),
        })
        return first.unionByName(final.withColumn(
            "_extracted_at", F.col("order_estimated_delivery_date")))

    @cached_property
    def raw_items(self) -> DataFrame:
        """Items with copies of a key; a returned line's price lands negated."""
        li = self.table("lineitem")
        price = F.col("l_extendedprice").cast(MONEY)
        return li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0), -price)
             .otherwise(price).alias("price"),
            F.col("l_quantity").cast(MONEY).alias("freight_value"),
            F.col("l_shipdate").alias("_extracted_at"),
        )

    @cached_property
    def moved_customers(self) -> DataFrame:
        """Address changes to apply to the customer dimension: everybody who
        lived in one city moves to another."""
        return self.customer_addresses.filter(F.col("city") == "household").select(
            "customer_unique_id",
            F.lit("curitiba").alias("city"), F.lit("PR").alias("state"),
            F.lit("80010").alias("zip_code_prefix"),
        )

    @cached_property
    def customer_addresses(self) -> DataFrame:
        """One address per person: that of the lowest customer id."""
        from ..operators.dedup import first_per_key
        return first_per_key(
            self.customers.select(
                "customer_unique_id", "customer_id",
                F.col("customer_city").alias("city"),
                F.col("customer_state").alias("state"),
                F.col("customer_zip_code_prefix").alias("zip_code_prefix")),
            ["customer_unique_id"], ["customer_id"],
        ).drop("customer_id")

    @cached_property
    def run_events(self) -> DataFrame:
        """The event table read as a step log: one row per (run, step)."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("user_id").alias("run_id"),
            F.concat(kind, F.lit("."), F.col("event_id")).alias("step"),
            F.col("ts").alias("started_at"),
            F.when(kind != "view", F.timestamp_add(
                "MICROSECOND", (F.col("value") * 1000).cast("int"), F.col("ts")))
             .alias("ended_at"),
            F.col("event_id").alias("rows_in"),
            (F.col("event_id") + 1).alias("rows_out"),
            F.when(kind == "error", F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
             .alias("rows_rejected"),
            F.when(kind == "error", "failed").when(kind == "view", "running")
             .otherwise("success").alias("status"),
            F.when(kind == "error", F.col("props")).alias("message"),
        )
