"""A third or more of the rows on one key: plans split it, results stay whole."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermill.operators.keys import assign_dense_keys
from ordermill.plans import questions

LIMITS = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
          "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def tight(spark):
    """Thresholds small enough for a test's data to count as skewed."""
    old = {k: spark.conf.get(k) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture()
def hot(tight):
    """40,000 items, half of them in one order."""
    n = 40_000
    orders = tight.range(2_000).select(
        F.col("id").alias("order_id"), (F.col("id") % 300).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.timestamp_add("DAY", (F.col("id") % 400).cast("int"),
                        F.lit("1997-01-01").cast("timestamp_ntz"))
        .alias("order_purchase_timestamp"))
    items = tight.range(n, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 2_000).alias("order_id"),
        F.col("id").alias("order_item_id"), (F.col("id") % 50).alias("seller_id"),
        F.md5(F.col("id").cast("string")).alias("pad"),
        F.lit("1.25").cast("decimal(12,2)").alias("price"))
    return orders, items


def test_hot_order_is_split_and_whole(hot):
    orders, items = hot
    wide = items.withColumn("price", F.when(F.length("pad") > 0, F.col("price")))
    df = questions.monthly_revenue(orders, wide, "1997-01-01", "1999-01-01")
    got = [tuple(r) for r in df.collect()]      # runs ``df``: its plan is final
    assert sum(float(r[1]) for r in got) == 40_000 * 1.25
    assert sum(r[2] for r in got) == items.select("order_id").distinct().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_order_counts_once_in_the_anti_join(hot):
    orders, items = hot
    paid = items.filter("order_id % 2 = 1 or order_id = 7")
    unpaid = questions.orders_without_payment(orders, paid, items)
    assert rows(unpaid, "order_id", "items") == sorted(
        ((k, 0) for k in range(0, 2_000, 2)), key=repr)


def test_dense_keys_need_no_single_task(spark):
    df = assign_dense_keys(spark.range(1000).toDF("n"), "n", "key")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step is the running sum over bucket sizes.
    assert plan.count("Exchange SinglePartition") == 1
    assert "Exchange hashpartitioning(_bucket" in plan
