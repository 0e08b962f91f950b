"""Layers that a run touches in part: buckets, states, marts, streams."""
from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from ordermill.operators import joins, quality
from ordermill.operators.fact import enrich
from ordermill.plans import elt, mart_layers, marts
from ordermill.schemas import SOURCE_DDL, Constraints
from ordermill.session import child_names
from ordermill.sources import layers as state
from ordermill.sources.layers import Layers, default_parts
from ordermill.streaming import ingest

AS_OF = dt.date(2019, 1, 1)
SETTINGS = elt.Settings(leading_zero_check=False)


class Shop:
    """A small source with string ids that changes between cycles."""

    def __init__(self, spark, seed=1, people=40, products=12):
        self.spark, self.rng = spark, random.Random(seed)
        self.rows = {n: {} for n in ("customers", "sellers", "products", "orders", "order_items")}
        for i in range(8):
            self.rows["sellers"][f"s{i}"] = (f"s{i}", f"0{1000 + i}", "town", "SP" if i % 2 else "RJ")
        for i in range(products):
            self.product(i, f"cat{i % 4}" if i % 5 else None)
        self.people = people

    def product(self, i, category):
        self.rows["products"][f"p{i}"] = (f"p{i}", category, 1, 2, 3, 4, 5, 6, 7)

    def order(self, number, at, person=None, status="delivered", items=2, zip_code=None):
        rng, oid, cid = self.rng, f"o{number}", f"c{number}"
        person = person or f"u{rng.randrange(self.people)}"
        zip_code = zip_code or f"{10000 + rng.randrange(30)}"
        self.rows["customers"][cid] = (cid, person, zip_code, "city", "SP" if zip_code < "10015" else "MG")
        arrived = at + dt.timedelta(days=rng.randrange(20)) if status == "delivered" else None
        self.rows["orders"][oid] = (oid, cid, status, at, at, None, arrived,
                                    at + dt.timedelta(days=10))
        for i in range(items):
            self.rows["order_items"][oid, i + 1] = (
                oid, i + 1, f"p{rng.randrange(len(self.rows['products']))}",
                f"s{rng.randrange(8)}", at, rng.randrange(1, 9000) / 100, 1.0)

    def month(self, year, month, n, start):
        for k in range(n):
            day = dt.datetime(year, month, self.rng.randrange(1, 28), self.rng.randrange(24))
            self.order(start + k, day, status=self.rng.choice(
                ["delivered"] * 4 + ["canceled", "shipped"]))

    def frame(self, name):
        ddl = SOURCE_DDL[name].replace("decimal(10,2)", "double")
        df = self.spark.createDataFrame(list(self.rows[name].values()), ddl)
        if name == "order_items":
            df = df.withColumns({c: F.col(c).cast("decimal(10,2)")
                                 for c in ("price", "freight_value")})
        return df

    def source(self):
        return SimpleNamespace(
            orders=self.frame("orders"), items=self.frame("order_items"),
            customers=self.frame("customers"), sellers=self.frame("sellers"),
            products=self.frame("products"), translation=self.spark.createDataFrame(
                [("cat1", "one"), ("cat2", "two")], SOURCE_DDL["product_category_translation"]))


def run(layers, shop, run_id, as_of=AS_OF, settings=SETTINGS, max_ts=None):
    return elt.Cycle(layers, shop.source(), run_id, as_of, settings).run(max_ts)


def full_marts(layers):
    """The marts built from all facts at once."""
    view = {k: layers.read(t) for t, (k, _) in mart_layers.SHOWN.items()}
    fact = enrich(layers.read(elt.FACT), view, [
        "category", "customer_state", "seller_id", "seller_state", "customer_unique_id"])
    return {"marts/revenue_daily": marts.revenue_daily(fact),
            "marts/delivery_performance": marts.delivery_performance(fact),
            "marts/customer_cohorts": marts.customer_cohorts(fact)}


def assert_marts_whole(layers):
    for table, want in full_marts(layers).items():
        columns = sorted(want.columns)
        assert rows(layers.read(table), *columns) == rows(want, *columns), table


def data_files(layers):
    found = set()
    for table in (*elt.STAGING, *elt.WAREHOUSE, *mart_layers.TABLES, "_work"):
        for name in child_names(layers.spark, layers.path(table)):
            found.add(f"{table}/{name}")
    return found


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Four cycles: two months, a later one, late and changed orders, a new category."""
    layers = Layers(spark, str(tmp_path_factory.mktemp("shop")), default_parts(4))
    shop = Shop(spark)
    shop.month(2018, 1, 30, 0)
    shop.month(2018, 2, 25, 100)
    run(layers, shop, 1)
    return layers, shop


def test_run_without_rows_writes_no_data_file(history):
    layers, shop = history
    before, pointers = data_files(layers), dict(layers._current())
    assert run(layers, shop, 2) == 0
    assert data_files(layers) == before
    assert {t: v.folders for t, v in layers._current().items()} == {
        t: v.folders for t, v in pointers.items()}


def test_marts_equal_a_full_build_after_each_cycle(history):
    layers, shop = history
    assert_marts_whole(layers)
    shop.month(2018, 4, 20, 200)
    run(layers, shop, 3)
    assert_marts_whole(layers)
    # Orders of a month that is long past arrive, others are canceled.
    late = [r for r in shop.rows["orders"].values() if r[3] < dt.datetime(2018, 1, 12)]
    source = shop.source()
    canceled = shop.spark.createDataFrame(
        [(*r[:2], "canceled", *r[3:]) for r in late], source.orders.schema)
    staged = layers.read("staging/orders")
    layers.replace(8, "staging/orders", staged.join(
        canceled.select("order_id"), "order_id", "left_anti").unionByName(
        staged.join(canceled.select("order_id"), "order_id").withColumn(
            "order_status", F.lit("canceled")).select(*staged.columns)))
    run(layers, shop, 4)
    assert layers.read(elt.FACT).filter("order_status = 'canceled'").count() >= len(late)
    assert_marts_whole(layers)


def test_changed_category_shows_in_all_periods(history):
    layers, shop = history
    shop.product(1, "cat2")
    run(layers, shop, 5)
    assert_marts_whole(layers)
    assert layers.read("warehouse/dim_product").filter(
        "product_id = 'p1' and category_en = 'two'").count() == 1


def test_one_month_run_reads_and_writes_touched_folders_only(history, monkeypatch):
    layers, shop = history
    shop.month(2018, 6, 3, 300)
    before = {t: dict(layers.published_parts(t)) for t in (
        "staging/orders", "staging/order_items", elt.FACT, "marts/delivery_performance")}
    listed = []

    def frame(self, version, plain=Layers._frame):
        if version is not None:
            listed.extend(f for f in version.folders.values() if f)
        return plain(self, version)

    monkeypatch.setattr(Layers, "_frame", frame)
    run(layers, shop, 6, settings=elt.Settings(leading_zero_check=False, fixed_identity=True))
    monkeypatch.undo()
    for table, old in before.items():
        now = layers.published_parts(table)
        assert {p for p in now if now[p] != old.get(p)} == {"201806"}, table
        read = {f for f in listed if f.startswith(f"{layers.path(table)}/")}
        assert read <= {now["201806"]}, table
    assert_marts_whole(layers)


def test_moved_customer_takes_earlier_facts_along(history):
    layers, shop = history
    cid, person, *_ = shop.rows["customers"]["c0"]
    staged = layers.read("staging/customers")
    layers.replace(9, "staging/customers", staged.withColumn("zip_code_prefix", F.when(
        F.col("customer_id") == cid, "99999").otherwise(F.col("zip_code_prefix"))))
    run(layers, shop, 10)
    geo = layers.read("warehouse/dim_geography").filter("zip_code_prefix = '99999'").first()
    facts = layers.read(elt.FACT).filter("order_id = 'o0'")
    assert {r["geo_key"] for r in facts.collect()} == {geo["geo_key"]}
    assert_marts_whole(layers)


def test_version_from_a_day_before_existing_orders(spark, tmp_path):
    layers, shop = Layers(spark, str(tmp_path), default_parts(4)), Shop(spark, 5)
    for n, day in enumerate((1, 40, 80, 120)):
        shop.order(n, dt.datetime(2018, 1, 1) + dt.timedelta(days=day), "u1", zip_code="10001")
    run(layers, shop, 1)
    was = {r["order_id"]: r["customer_key"] for r in layers.read(elt.FACT).collect()}
    layers.replace(5, "staging/customers", layers.read("staging/customers").withColumn(
        "city", F.lit("elsewhere")))
    run(layers, shop, 2, dt.date(2018, 3, 1))
    now = {r["order_id"]: r["customer_key"] for r in layers.read(elt.FACT).collect()}
    dim = {r["customer_key"]: r for r in layers.read("warehouse/dim_customer").collect()}
    assert len(dim) == 2 and len(now) == 4
    assert [now[o] == was[o] for o in ("o0", "o1", "o2", "o3")] == [True, True, False, False]
    assert dim[now["o3"]]["customer_city"] == "elsewhere" and not dim[was["o3"]]["is_current"]


def test_customer_who_changes_person_leaves_the_old_bucket(spark, tmp_path):
    layers, shop = Layers(spark, str(tmp_path), default_parts(4)), Shop(spark, 6)
    shop.order(1, ts("2018-01-05"), "u1")
    shop.order(2, ts("2018-01-06"), "u2")
    run(layers, shop, 1)
    shop.order(3, ts("2018-02-05"), "u9")
    shop.rows["orders"]["o3"] = ("o3", "c1", *shop.rows["orders"]["o3"][2:])
    shop.rows["customers"]["c1"] = ("c1", "u9", *shop.rows["customers"]["c1"][2:])
    run(layers, shop, 2)
    staged = layers.read("staging/customers").filter("customer_id = 'c1'").collect()
    assert [r["customer_unique_id"] for r in staged] == ["u9"]
    person = dict(rows(layers.read("warehouse/dim_customer"), "customer_key", "customer_unique_id"))
    facts = {r["order_id"]: person[r["customer_key"]] for r in layers.read(elt.FACT).collect()}
    assert facts == {"o1": "u9", "o2": "u2", "o3": "u9"}
    assert_marts_whole(layers)


# ---- gates from states ---------------------------------------------------------

def test_merged_states_equal_whole_tables(spark):
    rng = random.Random(4)
    data = [(rng.randrange(40), rng.randrange(4), rng.choice([None, -1.5, 2.25, 7.0]),
             rng.choice(["SP", "R", None]), rng.random() < 0.3) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, p int, price double, s string, flag boolean")
    df = df.withColumns({"price": F.col("price").cast("decimal(10,2)"),
                         "part": (F.col("k") % 5).cast("string")})
    parents = spark.range(30).select(F.col("id").cast("int").alias("k"))
    rules = Constraints(
        ("k",), ("s",), (("k", "parents"),), {"s": ["SP"]}, {"price": (0, 5)}, True,
        {"s": 2}, {"s": "^S"}, {"s": "R"}, totals=("price",), never={"p": 3},
        flags=(("k", "flag"),))
    frames = {"t": df, "parents": parents}
    checks = quality.constraint_checks("t", frames, rules)
    whole = {r["check"]: r["value"] for r in quality.evaluate(checks, frames).collect()}
    states = quality.measure(df, F.col("part"), quality.bound(checks, frames))
    assert len(states) == 5 and sum(s["rows"] for s in states.values()) == 300
    assert {c.name: float(quality.merged(c, {"t": states})) for c in checks} == whole
    assert len(checks) == len(whole) == 13


def test_keys_and_references_read_each_table_once(spark, tables):
    from ordermill.catalog.quality import TABLES
    frames = {"customers": tables.customers, "sellers": tables.sellers,
              "products": tables.products, "orders": tables.orders,
              "order_items": tables.items, "order_payments": tables.payments}
    checks = [c for n in TABLES for c in quality.constraint_checks(n, frames)
              if isinstance(c.value, (quality.Copies, quality.Reference))]
    plan = quality.evaluate(checks, frames)._jdf.queryExecution().optimizedPlan().toString()
    # Items and payments are two entities over one table.
    assert plan.count("Relation [") == 6 and plan.count("Join") == 0 and len(checks) == 11


def test_gate_names_all_failures_and_keeps_values(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", 2.0)], "order_id string, price double")
    checks = quality.constraint_checks("t", (), Constraints(
        ("order_id",), ranges={"price": (0, None)}))
    states = {"t": quality.measure(df, F.lit(""), checks)}
    with pytest.raises(quality.GateFailed) as stopped:
        quality.gate(checks, states, "staging")
    assert [(n, int(v)) for n, v, _ in stopped.value.failures] == [
        ("t primary key", 1), ("t.price in range", 1)]
    assert stopped.value.phase == "staging" and "t primary key" in str(stopped.value)


def test_marts_that_disagree_with_the_facts_are_stopped(spark, tmp_path, monkeypatch):
    layers, shop = Layers(spark, str(tmp_path), default_parts(4)), Shop(spark, 7)
    shop.month(2018, 1, 10, 0)
    double = marts.daily_sales
    monkeypatch.setattr(marts, "daily_sales", lambda fact: double(fact).withColumn(
        "revenue", F.col("revenue") * 2))
    with pytest.raises(quality.GateFailed, match="revenue less that of the facts"):
        run(layers, shop, 1)
    assert layers.read("marts/revenue_daily") is None
    monkeypatch.undo()
    run(layers, shop, 2)
    assert_marts_whole(layers)


# ---- as-of join ------------------------------------------------------------------

def test_many_versions_of_one_person_meet_no_more_rows_than_orders(spark):
    n = 5000
    day = F.expr("date_add(date'2000-01-01', cast(id as int))")
    versions = spark.range(n).select(
        F.lit(1).alias("person"), F.col("id").alias("key"), day.alias("valid_from"),
        F.date_add(day, 1).alias("valid_to"))
    facts = spark.range(2 * n).select(
        "id", F.lit(1).alias("person"),
        F.expr("date_add(date'1999-12-31', cast(id % 5003 as int))").alias("day"))
    out = joins.as_of(facts, versions, "person", "day", "key")
    got = {r["id"]: r["key"] for r in out.collect()}
    want = {i: i % 5003 - 1 for i in range(2 * n) if 0 <= i % 5003 - 1 < n}
    assert got == want

    def counts(node, found):
        if "Join" in node.nodeName():
            found.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        for i in range(children.size()):
            counts(children.apply(i), found)
        for inner in (["executedPlan"] if node.nodeName().startswith("Adaptive") else
                      ["plan"] if node.nodeName().endswith("QueryStage") else []):
            counts(getattr(node, inner)(), found)
        return found

    made = counts(out._jdf.queryExecution().executedPlan(), [])
    assert made and max(made) <= 2 * n


def test_as_of_gaps_and_borders(spark):
    versions = spark.createDataFrame(
        [("a", 1, "2018-01-01", "2018-02-01"), ("a", 2, "2018-03-01", "9999-12-31"),
         ("b", 3, "2018-01-15", "2018-01-16")], "p string, k int, f string, t string").select(
        "p", "k", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"))
    facts = spark.createDataFrame(
        [(p, d) for p in "abc" for d in ("2017-12-31", "2018-01-01", "2018-01-15", "2018-01-31",
                                         "2018-02-01", "2018-03-01")] + [("a", None)],
        "p string, d string").withColumn("d", F.col("d").cast("date"))
    got = rows(joins.as_of(facts, versions, "p", "d", "k").withColumn("d", F.col("d").cast("string")),
               "p", "d", "k")
    want = rows(joins.point_in_time(facts, versions, "p", F.col("d")).withColumn(
        "d", F.col("d").cast("string")), "p", "d", "k")
    assert got == want and len(got) == 5


# ---- streams ---------------------------------------------------------------------

def stream_over(spark, shop, name, folder, parts=3):
    """The shop's rows as a file stream of a few files, keys of an order together."""
    path = folder / name
    path.mkdir(parents=True, exist_ok=True)
    df = shop.frame(name)
    key = {"customers": "customer_id"}.get(name, "order_id")
    for i in range(parts):
        df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == i).toPandas().to_parquet(
            path / f"part-{i}.parquet", index=False, coerce_timestamps="us")
    schema = spark.read.parquet(str(path)).schema
    typed = {f.name: f.dataType for f in df.schema}
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))
            .select(*[F.col(c).cast(t) for c, t in typed.items()]))


def test_streams_in_any_order_give_the_staging_of_the_cycle(spark, tmp_path):
    shop = Shop(spark, 8)
    shop.month(2018, 1, 20, 0)
    shop.month(2018, 3, 10, 50)
    batch = Layers(spark, str(tmp_path / "batch"), default_parts(4))
    run(batch, shop, 1)
    for n, order in enumerate((["order_items", "orders", "customers"],
                               ["orders", "customers", "order_items"])):
        layers = Layers(spark, str(tmp_path / f"stream{n}"), default_parts(4))
        stream = ingest.StagingStream(layers)
        for name in order:
            source = stream_over(spark, shop, name, tmp_path / f"in{n}")
            for _ in range(2):      # the second start finds nothing new
                stream.run_available(name, source, str(tmp_path / f"ck{n}-{name}"))
        for table in elt.STAGING:
            assert rows(layers.read(table)) == rows(batch.read(table)), (order, table)
        # The cycle takes over from the staging tables.
        cycle = elt.Cycle(layers, shop.source(), 7, AS_OF, SETTINGS)
        cycle.transform()
        cycle.load()
        natural = ["order_id", "order_item_id", "date_key", "price", "is_late"]
        assert rows(layers.read(elt.FACT), *natural) == rows(batch.read(elt.FACT), *natural)


def raw_orders(spark, shop, versions):
    return shop.frame("orders").crossJoin(spark.createDataFrame(
        [(s, dt.datetime.fromisoformat(v)) for s, v in versions],
        "order_status string, _extracted_at timestamp_ntz").withColumnRenamed(
        "order_status", "_s")).withColumn("order_status", F.col("_s")).drop("_s")


def test_the_latest_version_stays_whatever_order_batches_arrive_in(spark, tmp_path):
    shop = Shop(spark, 9)
    shop.month(2018, 1, 5, 0)
    old = raw_orders(spark, shop, [("created", "2018-05-01")])
    new = raw_orders(spark, shop, [("shipped", "2018-06-01")])
    for n, batches in enumerate(([old, new], [new, old], [old.unionByName(new)])):
        layers = Layers(spark, str(tmp_path / f"l{n}"), default_parts(4))
        stream = ingest.StagingStream(layers)
        for i, batch in enumerate(batches):
            stream.merge_batch("orders", batch, "s", i)
        assert {r["order_status"] for r in layers.read("staging/orders").collect()} == {"shipped"}
        assert layers.read("staging/orders").count() == 5


def test_replayed_batches_change_nothing(spark, tmp_path, monkeypatch):
    """A batch that dies before its pointers are there is merged anew; one that died
    after them is skipped; ids of batches and of runs don't meet."""
    shop = Shop(spark, 10)
    shop.month(2018, 1, 6, 0)
    layers = Layers(spark, str(tmp_path), default_parts(4))
    stream = ingest.StagingStream(layers)
    items = shop.frame("order_items")
    for batch, when in enumerate(("before", "after")):
        def dies(spark, path, entries, append=state.append_state, when=when):
            if when == "after":
                append(spark, path, entries)
            raise RuntimeError("driver lost")

        with monkeypatch.context() as m:
            m.setattr(state, "append_state", dies)
            with pytest.raises(RuntimeError, match="lost"):
                stream.merge_batch("order_items", items, "s", batch)
        layers = Layers(spark, layers.root, default_parts(4))
        stream = ingest.StagingStream(layers)
        if when == "before":
            assert layers.read("staging/order_items") is None
            stream.merge_batch("order_items", items, "s", batch)
        once = rows(layers.read("staging/order_items"))
        folders = layers.published_parts("staging/order_items")
        assert len(once) == len(shop.rows["order_items"])
        stream.merge_batch("order_items", items.limit(1), "s", batch)
        assert layers.published_parts("staging/order_items") == folders
        assert rows(layers.read("staging/order_items")) == once
    assert all(r < 0 for r in layers.landed_runs("raw/order_items"))
    assert ingest.batch_run_id("a", 1) != ingest.batch_run_id("a", 2)


def test_items_without_an_order_are_stopped_by_the_gate(spark, tmp_path):
    shop = Shop(spark, 11)
    shop.month(2018, 1, 4, 0)
    layers = Layers(spark, str(tmp_path), default_parts(4))
    stream = ingest.StagingStream(layers)
    stream.merge_batch("order_items", shop.frame("order_items"), "i", 0)
    stream.merge_batch("customers", shop.frame("customers"), "c", 0)
    stream.merge_batch("orders", shop.frame("orders").filter("order_id <> 'o1'"), "o", 0)
    with pytest.raises(quality.GateFailed, match="items.order_id references orders: 2 = 0"):
        elt.Cycle(layers, shop.source(), 1, AS_OF, SETTINGS).transform()
    stream.merge_batch("orders", shop.frame("orders").filter("order_id = 'o1'"), "o", 1)
    elt.Cycle(layers, shop.source(), 2, AS_OF, SETTINGS).transform()
    assert set(layers.published_parts("staging/order_items")) == {"201801"}


# ---- state files, reset, settings --------------------------------------------------

def test_pointers_and_log_are_compacted(spark, tmp_path):
    from ordermill.operators.run_log import RunLog, read_log
    layers = Layers(spark, str(tmp_path))
    layers.replace(1, "t", spark.range(3))
    log_path = layers.path("meta/run_log")
    for run_id in range(120):
        log = RunLog(spark, log_path, run_id)
        with log.step("s") as c:
            c["rows_out"] = run_id
        layers.publish(run_id, [], seen={"x/raw": {str(run_id % 7): str(run_id)}})
        log.compact(30)
        layers.compact(30)
        assert len(child_names(spark, log_path)) <= 70
        assert len(child_names(spark, layers.path(state.POINTERS))) <= 70
    again = Layers(spark, layers.root)
    assert again.read("t").count() == 3
    assert again.published_parts(f"{state.SEEN}x/raw") == {
        str(i): str(max(r for r in range(120) if r % 7 == i)) for i in range(7)}
    assert rows(read_log(spark, log_path), "run_id", "rows_out", "status") == sorted(
        [(r, r, "success") for r in range(120)], key=repr)


def test_reset_that_dies_is_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    layers, shop = Layers(spark, str(tmp_path), default_parts(4)), Shop(spark, 12)
    shop.month(2018, 1, 6, 0)
    settings = elt.Settings(leading_zero_check=False, unknown_geography=True)
    run(layers, shop, 1, settings=settings)
    want = rows(layers.read("staging/orders"))

    def dies(*a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(state, "append_state", dies)
        with pytest.raises(RuntimeError):
            elt.reset(layers, 2)
    layers = Layers(spark, layers.root, default_parts(4))
    assert rows(layers.read("staging/orders")) == want
    with monkeypatch.context() as m:
        m.setattr(elt, "delete_path", dies)
        with pytest.raises(RuntimeError):
            elt.reset(layers, 2)
    layers = Layers(spark, layers.root, default_parts(4))
    assert layers.read("staging/orders").isEmpty() and state.read_mark(layers, elt.MARK) == state.EPOCH
    assert layers.read("warehouse/dim_geography").select("geo_key").collect()[0][0] == -1
    assert run(layers, shop, 1, settings=settings) == 6    # also with a run id used before
    assert rows(layers.read("staging/orders")) == want
    assert layers.read("warehouse/dim_geography").filter("geo_key = -1").count() == 1
    assert_marts_whole(layers)


def test_unknown_geography_has_a_member_in_the_cycle(spark, tmp_path):
    layers, shop = Layers(spark, str(tmp_path), default_parts(4)), Shop(spark, 13)
    shop.month(2018, 1, 6, 0)
    run(layers, shop, 1, settings=elt.Settings(
        leading_zero_check=False, unknown_geography=True, no_unknown_check=True,
        seller_zips=False, update_transit_dates=False))
    geo = layers.read("warehouse/dim_geography")
    assert geo.filter("geo_key = -1 and zip_code_prefix = 'n/a'").count() == 1
    zips = {r[2] for r in shop.rows["customers"].values()}
    assert {r["zip_code_prefix"] for r in geo.collect()} == zips | {"n/a"}
    assert geo.select("geo_key").distinct().count() == geo.count()


def test_transit_dates_and_the_inclusive_bound(spark, tmp_path):
    for inclusive, update in ((True, True), (False, False)):
        layers = Layers(spark, str(tmp_path / str(inclusive)), default_parts(4))
        shop = Shop(spark, 14)
        shop.order(1, ts("2018-01-05"))
        shop.order(2, ts("2018-01-06"))
        settings = elt.Settings(leading_zero_check=False, inclusive_max_ts=inclusive,
                                update_transit_dates=update)
        assert run(layers, shop, 1, settings=settings, max_ts=ts("2018-01-06")) == 1 + inclusive
        row = shop.rows["orders"]["o1"]
        shop.rows["orders"]["o1"] = (*row[:3], ts("2018-03-01"), ts("2018-03-02"), *row[5:])
        run(layers, shop, 2, settings=settings)
        staged = layers.read("staging/orders").filter("order_id = 'o1'").first()
        assert staged["order_purchase_timestamp"] == ts("2018-01-05")
        assert staged["order_approved_at"] == (ts("2018-03-02") if update else ts("2018-01-05"))
        assert layers.read("staging/orders").count() == 2


def test_decimal_money_in_the_revenue_mart(history):
    layers = history[0]
    fact = enrich(layers.read(elt.FACT), {k: layers.read(t) for t, (k, _) in
                                          mart_layers.SHOWN.items()}, marts.REVENUE_NEEDS)
    exact = marts.revenue_daily(fact, money="decimal")
    assert dict(exact.dtypes)["revenue"].startswith("decimal")
    assert rows(exact.withColumn("revenue", F.col("revenue").cast("double"))) == rows(
        marts.revenue_daily(fact))
