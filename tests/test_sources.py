"""CSV edge cases, JDBC options, sinks and scans."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from ordermill.operators.plan_audit import partition_layout, plan_stats
from ordermill.schemas import SOURCE_DDL
from ordermill.sources import csv_tables, parquet_io
from ordermill.sources.jdbc import Split, jdbc_options


def test_csv_edge_cases(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes(
        "﻿review_id,order_id,review_score,review_comment_title,"
        "review_comment_message,review_creation_date,review_answer_timestamp\r\n"
        'r1,o1,5,"say ""hi""","two\nlines",2018-01-01 00:00:00,2018-01-02 03:04:05\r\n'
        'r2,o1,1,,"",2018-01-01 00:00:00,2018-01-02 00:00:00\r\n'.encode())
    df = csv_tables.read_csv(spark, str(tmp_path / "r.csv"), SOURCE_DDL["order_reviews"],
                             multi_line=True)
    assert rows(df, "review_id", "review_score", "review_comment_title",
                "review_comment_message", "review_answer_timestamp") == [
        ("r1", 5, 'say "hi"', "two\nlines", ts("2018-01-02 03:04:05")),
        ("r2", 1, None, None, ts("2018-01-02"))]


def test_csv_keeps_leading_zeros_and_fails_on_bad_rows(spark, tmp_path):
    header = ("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,"
              "customer_state\n")
    (tmp_path / "c.csv").write_text(header + "c,p,01037,sao paulo,SP\n")
    df = csv_tables.read_csv(spark, str(tmp_path / "c.csv"), SOURCE_DDL["customers"])
    assert df.first()["customer_zip_code_prefix"] == "01037"
    (tmp_path / "i.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,"
        "freight_value\no,one,p,s,2018-01-01 00:00:00,1.00,1.00\n")
    bad = csv_tables.read_csv(spark, str(tmp_path / "i.csv"), SOURCE_DDL["order_items"])
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        bad.collect()


def test_load_rejects_everything_on_one_mismatch(spark, tmp_path):
    two, one = spark.range(2), spark.range(1)
    with pytest.raises(csv_tables.LoadRejected, match="orders: got 1, expected 5"):
        csv_tables.load_sources({"customers": two, "orders": one}, str(tmp_path / "s"),
                                {"customers": 2, "orders": 5})
    assert not (tmp_path / "s").exists()
    report = csv_tables.load_sources({"customers": two}, str(tmp_path / "s"),
                                     {"customers": 2})
    assert rows(report) == [("customers", 2, 2, True)]
    assert (tmp_path / "s" / "customers").exists()


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "warehouse.fact", "u", "p", "d")
    assert plain["dbtable"] == "warehouse.fact" and "partitionColumn" not in plain
    split = jdbc_options("jdbc:x", "t", "u", "p", "d", Split("date_key", 20160101,
                                                             20191231, 64))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("date_key", "20160101", "20191231", "64")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "u", "p", "d", Split("k", 0, 1, 0))


def test_partitioned_sink_one_file_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(400).select("id", (F.col("id") % 2 + 2017).cast("int").alias("year"),
                                 (F.col("id") % 3 + 1).cast("int").alias("month"))
    parquet_io.write_partitioned(df.repartition(8), path)
    layout = partition_layout(spark.read.parquet(path), ["year", "month"])
    assert layout.count() == 6 and all(r["files"] == 1 for r in layout.collect())
    parquet_io.write_partitioned(
        df.filter("year = 2018 and month = 1 and id < 10"), path, dynamic=True)
    back = spark.read.parquet(path)
    assert back.filter("year = 2017").count() == 200
    assert back.filter("year = 2018 and month = 1").count() < 10


def test_pruned_scan_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(50).select("id", F.lit("x").alias("wide"),
                                (F.col("id") % 2 + 2017).cast("int").alias("year"),
                                F.lit(1).alias("month"))
    parquet_io.write_partitioned(df, path)
    plan = parquet_io.read_pruned(spark, path, "year = 2018 and id > 5", ["id"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<id:bigint>" in plan
    assert "GreaterThan(id,5)" in plan


def test_question_filters_reach_the_scan(tables):
    from ordermill.plans.questions import monthly_revenue
    plan = monthly_revenue(tables.orders, tables.items, "1997-01-01", "1999-01-01") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "l_discount" not in plan and "o_orderpriority" not in plan


def test_join_hints_give_equal_rows(spark, tables):
    sellers = tables.sellers.select("seller_id", "seller_state")
    hashed = tables.items.join(F.broadcast(sellers), "seller_id")
    merged = tables.items.join(sellers.hint("merge"), "seller_id")
    assert plan_stats(hashed)["broadcast_join"] == 1
    assert plan_stats(merged) == {"sort_merge": 1, "broadcast_join": 0, "shuffles": 2}
    assert merged.count() and plan_stats(merged)["shuffles"] == 2  # as before it ran
    assert hashed.exceptAll(merged).count() == 0 == merged.exceptAll(hashed).count()
