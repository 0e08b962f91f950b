"""Stateful and order-sensitive operators on hand-made rows."""
from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import day, rows, ts
from ordermill.functions.scalars import clean_place, iso_weekday, mean, month_offset, pct
from ordermill.operators import dimensions as dims
from ordermill.operators import joins, quality, staging, windows
from ordermill.operators.dedup import duplicate_summary, first_per_key, latest_per_key
from ordermill.operators.keys import assign_dense_keys, extend_keys
from ordermill.operators.merge import upsert_ignore, upsert_update
from ordermill.operators.scd2 import change_counts, one_address_per_person, scd2_merge

RAW_CUSTOMER = ("customer_id string, customer_unique_id string, "
                "customer_zip_code_prefix string, customer_city string, "
                "customer_state string, _extracted_at timestamp_ntz")
T1, T2 = ts("2020-01-01"), ts("2020-01-02")


# ---- cleaning ---------------------------------------------------------------

CUSTOMERS = [
    ("c1", "p1", " 01037 ", "  SAO   Paulo ", "sp ", T1),
    ("c1", "p1", "01037", "Campinas", "SP", T2),
    ("c2", "p2", "20010", "rio\tde  janeiro", "rj", T1),
    ("c3", "p3", "1", "b", "aa", T1),
    ("c3", "p3", "1", "a", "aa", T1),          # tie on the extraction time
    (None, "p4", "1", "x", "yy", T1),
]
CLEAN = [("c1", "p1", "01037", "campinas", "SP"),
         ("c2", "p2", "20010", "rio de janeiro", "RJ"),
         ("c3", "p3", "1", "b", "AA")]


def test_stage_customers(spark):
    good, bad = staging.stage_customers(spark.createDataFrame(CUSTOMERS, RAW_CUSTOMER))
    assert rows(good) == CLEAN
    assert rows(bad, "customer_unique_id") == [("p4",)]


def test_stage_customers_ignores_row_order(spark):
    shuffled = list(CUSTOMERS)
    for seed in range(3):
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, RAW_CUSTOMER).repartition(seed + 1)
        assert rows(staging.stage_customers(df)[0]) == CLEAN


RAW_ORDER = ("order_id string, customer_id string, order_status string, "
             "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
             "order_delivered_carrier_date timestamp_ntz, "
             "order_delivered_customer_date timestamp_ntz, "
             "order_estimated_delivery_date timestamp_ntz, _extracted_at timestamp_ntz")


def order(oid, status, bought, delivered, promised, at=T1):
    return (oid, "c1", status, bought and ts(bought), None, None,
            delivered and ts(delivered), promised and ts(promised), at)


def test_stage_orders(spark):
    raw = spark.createDataFrame([
        order("o1", " DELIVERED ", "2018-01-01 23:00", "2018-01-03 01:00", "2018-01-05"),
        order("o2", "delivered", "2018-01-01", "2018-01-05 10:00", "2018-01-05"),
        order("o3", "shipped", "2018-01-01", None, "2018-01-05"),
        order("o3", "created", "2018-01-01", None, "2018-01-05", ts("2021-01-01")),
        order("o4", "shipped", None, None, "2018-01-05"),
        order("o5", "shipped", "2018-01-01", None, None),
        order(None, "shipped", "2018-01-01", None, "2018-01-05"),
    ], RAW_ORDER)
    good, bad = staging.stage_orders(raw)
    assert rows(good, "order_id", "order_status", "delivery_days", "days_vs_estimate",
                "is_late") == [
        ("o1", "delivered", 2, -2, False),
        ("o2", "delivered", 4, 0, True),       # on the promised day, but later
        ("o3", "created", None, None, None)]
    assert bad.count() == 3


def test_stage_items_rejects_bad_money(spark):
    raw = spark.createDataFrame(
        [("o1", 1, "p", "s", None, "10.00", "1.00", T1),
         ("o1", 1, "p", "s", None, "12.00", "1.00", T2),
         ("o1", 2, "p", "s", None, "-1.00", "1.00", T1),
         ("o1", 3, "p", "s", None, None, "1.00", T1),
         ("o1", 4, "p", "s", None, "1.00", "-1.00", T1)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price string, freight_value string, "
        "_extracted_at timestamp_ntz",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")})
    good, bad = staging.stage_items(raw)
    assert [(r.order_item_id, float(r.price)) for r in good.collect()] == [(1, 12.0)]
    assert rows(bad, "order_item_id") == [(2,), (3,), (4,)]


# ---- dedup, merge, keys -----------------------------------------------------

def test_latest_per_key_hot_key(spark):
    """One key holds nearly all rows; the group limit runs before the shuffle."""
    df = spark.range(20_000).select(
        F.when(F.col("id") < 19_000, 0).otherwise(F.col("id")).alias("k"), "id",
        F.col("id").alias("_extracted_at"))
    latest = latest_per_key(df, ["k"])
    assert latest.count() == 1_001
    assert latest.filter("k = 0").first()["id"] == 18_999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("Exchange hashpartitioning") == 1


def test_duplicate_summary_counts_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, None)],
                               "a int, b int")
    assert rows(duplicate_summary(df, ["a", "b"])) == [(4, 3, 1)]
    assert rows(duplicate_summary(df.limit(0), ["a", "b"])) == [(0, 0, 0)]


def test_upsert_update_subset(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "new"), (3, "c", "z")], old.schema)
    merged = upsert_update(old, new, ["k"], ["v"])
    assert rows(merged) == [(1, "a", "x"), (2, None, "y"), (3, "c", "z")]
    assert rows(upsert_update(merged, new, ["k"], ["v"])) == rows(merged)
    assert rows(upsert_update(old.limit(0), new, ["k"], ["v"])) == rows(new)


def test_upsert_ignore(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], old.schema)
    assert rows(upsert_ignore(old, new, ["k"])) == [(1, "a"), (2, "c")]


def test_dense_keys_are_dense_and_repeatable(spark):
    df = spark.range(5_000).select(F.concat(F.lit("k"), "id").alias("n"))
    a = assign_dense_keys(df.repartition(3), "n", "key")
    b = assign_dense_keys(df.repartition(7), "n", "key")
    assert rows(a) == rows(b)
    assert sorted(r["key"] for r in a.collect()) == list(range(1, 5_001))
    assert assign_dense_keys(df.limit(0), "n", "key").count() == 0


def test_extend_keys_keeps_known(spark):
    old = spark.createDataFrame([(-1, "n/a"), (7, "a")], "key long, n string")
    merged = spark.createDataFrame([(-1, "n/a"), (7, "a"), (None, "b"), (None, "c")],
                                   "key long, n string")
    got = dict((n, k) for k, n in rows(extend_keys(old, merged, "n", "key")))
    assert (got["n/a"], got["a"]) == (-1, 7) and {got["b"], got["c"]} == {8, 9}
    only = old.filter("key = -1")
    fresh = extend_keys(only, merged.filter("n <> 'a'"), "n", "key")
    assert sorted(r["key"] for r in fresh.collect()) == [-1, 1, 2]


# ---- SCD2 -------------------------------------------------------------------

DIM = ("customer_key long, customer_unique_id string, customer_city string, "
       "customer_state string, zip_code_prefix string, valid_from date, valid_to date, "
       "is_current boolean")
ADDRESS = "customer_unique_id string, city string, state string, zip_code_prefix string"
END, OPENED, TODAY = day("9999-12-31"), day("2016-01-01"), day("2018-06-01")


@pytest.fixture()
def history(spark):
    dim = spark.createDataFrame([
        (1, "same", "a", "SP", "1", OPENED, END, True),
        (2, "moved", "a", "SP", "1", OPENED, END, True),
        (3, "today", "a", "SP", "1", TODAY, END, True),
        (4, "gone", "a", "SP", "1", OPENED, END, True),
        (5, "null", None, "SP", "1", OPENED, END, True),
        (6, "moved", "z", "SP", "1", day("2015-01-01"), OPENED, False)], DIM)
    incoming = spark.createDataFrame([
        ("same", "a", "SP", "1"), ("moved", "b", "SP", "1"), ("today", "b", "SP", "1"),
        ("null", None, "SP", "1"), ("fresh", "c", "RJ", "2")], ADDRESS)
    return dim, incoming


def test_scd2_merge_outcomes(history):
    dim, incoming = history
    merged = scd2_merge(dim, incoming, TODAY)
    got = rows(merged, "customer_unique_id", "customer_city", "valid_from", "valid_to",
               "is_current", "change")
    assert got == sorted([
        ("same", "a", OPENED, END, True, "unchanged"),
        ("moved", "a", OPENED, TODAY, False, "versioned"),
        ("moved", "b", TODAY, END, True, "versioned"),
        ("moved", "z", day("2015-01-01"), OPENED, False, "history"),
        ("today", "b", TODAY, END, True, "corrected"),
        ("gone", "a", OPENED, END, True, "untouched"),
        ("null", None, OPENED, END, True, "unchanged"),
        ("fresh", "c", OPENED, END, True, "new")], key=repr)
    assert rows(change_counts(merged)) == [(1, 1, 1, 1)]


def test_scd2_merge_again_changes_nothing(history):
    dim, incoming = history
    once = extend_keys(dim, scd2_merge(dim, incoming, TODAY).drop("change"),
                       "customer_unique_id", "customer_key")
    twice = scd2_merge(once, incoming, TODAY)
    assert rows(twice.drop("change")) == rows(once)
    assert rows(change_counts(twice)) == [(0, 0, 0, 0)]


def test_one_address_is_lowest_id_in_any_order(spark):
    data = [("c2", "p", "b", "SP", "2"), ("c1", "p", "a", "SP", "1"),
            ("c3", "p", "c", "SP", "3")]
    ddl = ("customer_id string, customer_unique_id string, city string, state string, "
           "zip_code_prefix string")
    for perm in itertools.permutations(data):
        assert rows(one_address_per_person(spark.createDataFrame(list(perm), ddl))) == [
            ("p", "a", "SP", "1")]


def test_point_in_time_boundaries(spark, history):
    dim, incoming = history
    versions = scd2_merge(dim, incoming, TODAY)
    facts = spark.createDataFrame(
        [(1, "moved", day("2018-05-31")), (2, "moved", TODAY), (3, "moved", OPENED)],
        "f int, customer_unique_id string, d date")
    got = joins.point_in_time(facts, versions, "customer_unique_id", F.col("d"))
    assert rows(got, "f", "customer_city") == [(1, "a"), (2, "b"), (3, "a")]


# ---- dimensions -------------------------------------------------------------

def test_geography_modal_ties_and_fill(spark):
    geo = spark.createDataFrame(
        [("01037", 1.0, 3.0, "b", "SP"), ("01037", 2.0, 5.0, "a", "SP"),
         ("01037", 3.0, 1.0, "a", "RJ"), ("01037", 4.0, 1.0, "b", "SP"),
         ("2", 1.0, 1.0, "z", "SP"), ("2", 1.0, 1.0, "y", "SP")],
        "geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string")
    customers = spark.createDataFrame([("2", "q", "SP")], "customer_zip_code_prefix "
                                      "string, customer_city string, customer_state string")
    sellers = spark.createDataFrame([("3", "s", "SP")], "seller_zip_code_prefix string, "
                                    "seller_city string, seller_state string")
    assert rows(dims.dim_geography(geo, customers, sellers)) == [
        ("01037", "b", "SP", 2.5, 2.5), ("2", "y", "SP", 1.0, 1.0),
        ("3", "s", "SP", None, None)]


def test_lookup_falls_back_to_unknown(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "z string")
    dim = spark.createDataFrame([("a", 5)], "z string, geo_key long")
    assert rows(joins.lookup_or_unknown(facts, dim, "z", "geo_key"), "z", "geo_key") == [
        ("a", 5), ("b", -1), (None, -1)]


def test_reference_calendar(spark):
    bounds = spark.sql("select date'2016-01-01' as lo, date'2019-12-31' as hi")
    calendar = dims.dim_date(bounds)
    assert calendar.count() == 1_461
    leap = calendar.filter("date_key = 20160229").first()
    assert (leap["day_of_week"], leap["day_name"], leap["week_of_year"]) == (1, "Monday", 9)
    assert leap["month_end"] == day("2016-02-29") and not leap["is_weekend"]
    assert quality.calendar_gaps(calendar).first()["value"] == 0
    hole = calendar.filter("date_key <> 20170101")
    assert quality.calendar_gaps(hole).first()["value"] == 1


def test_initial_customer_takes_latest_order(spark):
    customers = spark.createDataFrame(
        [("c1", "p", "old", "SP", "1"), ("c2", "p", "new", "SP", "2"),
         ("c3", "q", "only", "RJ", "3")],
        "customer_id string, customer_unique_id string, customer_city string, "
        "customer_state string, customer_zip_code_prefix string")
    orders = spark.createDataFrame([("c1", ts("2017-01-01")), ("c2", ts("2018-01-01"))],
                                   "customer_id string, order_purchase_timestamp "
                                   "timestamp_ntz")
    assert rows(dims.dim_customer_initial(customers, orders), "customer_unique_id",
                "customer_city") == [("p", "new"), ("q", "only")]
    assert rows(dims.dim_customer_initial(customers, None), "customer_unique_id",
                "customer_city") == [("p", "old"), ("q", "only")]


# ---- windows ----------------------------------------------------------------

def test_rolling_rows_and_days_differ_on_gaps(spark):
    df = spark.createDataFrame(
        [("x", day("2020-01-01"), 10), ("x", day("2020-01-02"), 20),
         ("x", day("2020-02-01"), 60)], "g string, d date, v int")
    by_rows = windows.rolling_rows(df, ["g"], "d", "v")
    by_days = windows.rolling_days(df, ["g"], "d", "v")
    assert rows(by_rows, "v_7d_avg", "days_in_window") == [(10.0, 1), (15.0, 2), (30.0, 3)]
    assert rows(by_days, "v_7d_avg", "days_in_window") == [(10.0, 1), (15.0, 2), (60.0, 1)]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("s", "a", 3), ("s", "b", 3), ("s", "c", 2), ("s", "d", 1)],
                               "state string, c string, v int")
    got = windows.top_n(df, ["state"], [F.desc("v")], 3)
    assert rows(got, "rnk", "c") == [(1, "a"), (1, "b"), (3, "c")]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_growth_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, 4)], "m int, v int")
    assert [r["growth_pct"] for r in windows.growth(df, "m", "v").orderBy("m").collect()] \
        == [None, None, -20.0]


def test_share_is_taken_before_the_limit(spark):
    df = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "k string, v int")
    top = windows.share_of_total(df, "v").orderBy(F.desc("v")).limit(1)
    assert rows(top) == [("a", 50, 50.0)]


# ---- scalars ----------------------------------------------------------------

def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"), 1)).collect()] == [
        12.5, -12.5, None]
    five = spark.createDataFrame([(0,), (0,), (0,), (1,)], "v int")
    assert five.agg(mean(F.col("v"), 1)).first()[0] == 0.3


def test_scalars(spark):
    row = spark.sql("select '  A \t B ' as p, date'2024-01-07' as d, "
                    "date'2023-11-30' as e").select(
        clean_place(F.col("p")), iso_weekday(F.col("d")),
        month_offset(F.col("d"), F.col("e"))).first()
    assert tuple(row) == ("a b", 7, 2)


def test_first_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "0")],
                               "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 5, "a")]


def test_not_in_null_trap(spark):
    spark.createDataFrame([(1,), (None,)], "x int").createOrReplaceTempView("holds_null")
    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("numbers")
    assert spark.sql("select * from numbers where x not in "
                     "(select x from holds_null)").count() == 0
    assert spark.table("numbers").join(spark.table("holds_null"), "x",
                                       "left_anti").count() == 1


def test_small_side_checks_size(spark):
    big, small = spark.range(100), spark.range(5)
    plan = big.join(joins.small_side(small, 10), "id")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
    assert joins.small_side(big, 10) is big


@pytest.mark.parametrize("build", [
    lambda s: latest_per_key(s.createDataFrame([], "k int, _extracted_at int"), ["k"]),
    lambda s: windows.growth(s.createDataFrame([], "m int, v int"), "m", "v"),
    lambda s: windows.rolling_days(s.createDataFrame([], "g int, d date, v int"),
                                   ["g"], "d", "v"),
    lambda s: joins.count_children(s.createDataFrame([], "k int"),
                                   s.createDataFrame([], "k int"), ["k"], "n"),
    lambda s: windows.sequence_gaps(s.createDataFrame([], "d date"), "d"),
])
def test_empty_inputs(spark, build):
    df = build(spark)
    assert df.count() == 0 and df.columns
