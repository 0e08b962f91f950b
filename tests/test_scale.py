"""What keeps the work of larger tables small: width of key rows, runs without orders,
partitioned writes without a sort."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import functions as F

from conftest import rows, ts
from ordermill.catalog.base import Tables
from ordermill.operators import quality, staging
from ordermill.plans import elt
from ordermill.session import TASK_BYTES, handle_skew, small_tasks
from ordermill.sources.layers import Layers


def values(checks, frames):
    return {r["check"]: r["value"] for r in quality.evaluate(checks, frames).collect()}


def test_keys_of_mixed_types_are_counted_by_value(spark):
    """Numbers of several widths, numbers beside texts, nulls in keys and references."""
    frames = {
        "p": spark.createDataFrame([(1, "1"), (2, "x"), (2, "x"), (None, None)],
                                   "id long, code string"),
        "c": spark.createDataFrame(
            [(1, 1, 1), (1, 1, 3), (None, 2, None), (None, 2, 9)],
            "a int, b smallint, ref int")}
    checks = [
        quality.Check("p key", "p", quality.Copies(("id",))),
        quality.Check("c key", "c", quality.Copies(("a", "b"))),
        quality.Check("numbers", "c", quality.Reference("ref", "p", "id")),
        quality.Check("number in texts", "c", quality.Reference("ref", "p", "code")),
        quality.Check("text in numbers", "p", quality.Reference("code", "c", "b"))]
    assert values(checks, frames) == {
        "p key": 1, "c key": 2, "numbers": 2, "number in texts": 2, "text in numbers": 2}


def test_whole_number_keys_stay_numbers(spark):
    frames = {"p": spark.range(3).toDF("id"),
              "c": spark.range(5).select(F.col("id").cast("int").alias("ref"))}
    checks = [quality.Check("p key", "p", quality.Copies(("id",))),
              quality.Check("ref", "c", quality.Reference("ref", "p", "id"))]
    plan = quality.key_counts(checks, frames)._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan and values(checks, frames) == {"p key": 0, "ref": 2}


def test_a_run_without_orders_reads_no_children(spark, tables, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    settings = elt.Settings(marts=False)
    as_of = dt.date(2002, 1, 1)
    whole = elt.Cycle(layers, tables, 1, as_of, settings)
    assert whole.extract() > 0
    unread = F.raise_error(F.lit("children were read")).cast("boolean")
    source = SimpleNamespace(orders=tables.orders, items=tables.items.filter(unread),
                             customers=tables.customers.filter(unread))
    assert elt.Cycle(layers, source, 2, as_of, settings).extract() == 0
    assert layers.landed_runs("raw/order_items") == [1]


def test_partitioned_writes_need_no_sort(spark, tmp_path):
    handle_skew(spark)
    spark.sql("create table written_by_part (a long, p int) using parquet "
              f"partitioned by (p) location '{tmp_path / 'written'}'")
    try:
        insert = ("insert into written_by_part select /*+ rebalance(p) */ id, p from "
                  "(select id, cast(id % 20 as int) as p from range(200))")
        assert "Sort" not in spark.sql(f"explain {insert}").first()[0]
        spark.sql(insert)
        assert spark.table("written_by_part").groupBy("p").count().filter(
            "count = 10").count() == 20
    finally:
        spark.sql("drop table written_by_part")


def test_staged_rows_carry_the_latest_version_of_their_key(spark):
    """Rejected rows don't count, and a version that is NULL is the earliest."""
    raw = spark.createDataFrame(
        [(1, 1, 5.0, 1.0, ts("2020-01-01")), (1, 1, 6.0, 1.0, ts("2020-01-02")),
         (1, 1, -7.0, 1.0, ts("2020-01-03")), (2, 1, 5.0, 1.0, None),
         (2, 1, 4.0, 1.0, ts("2020-01-01")), (3, 1, 3.0, 1.0, None)],
        "order_id long, order_item_id int, price double, freight_value double, "
        "_extracted_at timestamp_ntz")
    kept, _ = staging.stage_items(raw, "version")
    assert {(r["order_id"], r["price"], r["version"]) for r in kept.collect()} == {
        (1, 6.0, ts("2020-01-02")), (2, 4.0, ts("2020-01-01")), (3, 3.0, None)}
    assert rows(kept.drop("version")) == rows(staging.stage_items(raw)[0])


def test_order_data_is_read_and_shuffled_in_small_tasks(spark, tmp_path):
    """A session's larger tasks are made smaller, its smaller ones stay; rows are the
    same, and items are sorted without a copy of their date."""
    old = {k: spark.conf.get(k) for k in TASK_BYTES}
    lines = [(1, 1, 5, 6, ts("1997-01-02"), 2.5, 1.0), (1, 1, 5, 6, ts("1997-01-03"), 3.5, 1.0),
             (1, 1, 9, 6, ts("1997-01-03"), 4.5, 1.0), (None, 1, 5, 6, None, None, 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, "
                          "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, "
                          "l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    try:
        for k in TASK_BYTES:
            spark.conf.set(k, "128m")
        items = Tables(spark, str(tmp_path)).staged_items
        assert all(spark.conf.get(k) == f"{n}b" for k, n in TASK_BYTES.items())
        assert "_extracted_at" not in items._jdf.queryExecution().analyzed().toString()
        assert rows(items, "order_id", "product_id", "price") == sorted(
            [(None, 5, None), (1, 9, Decimal("4.50"))], key=repr)
        for k in TASK_BYTES:
            spark.conf.set(k, "1m")
        small_tasks(spark)
        assert all(spark.conf.get(k) == "1m" for k in TASK_BYTES)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
