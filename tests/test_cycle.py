"""Incremental cycles: idempotency, gates, recovery, streaming."""
from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from ordermill.operators import quality, run_log, staging
from ordermill.plans import elt
from ordermill.sources import layers as state
from ordermill.sources.layers import Layers

AS_OF = dt.date(2002, 1, 1)
CUTOFF = dt.datetime(1998, 1, 1)
SETTINGS = elt.Settings(calendar=("1995-01-01", "2001-12-31"),
                        first_valid_from="1995-01-01", months_per_partition=12)
STATE = ["staging/orders", "staging/order_items", "staging/customers",
         "warehouse/dim_customer", "warehouse/dim_geography",
         "warehouse/fact_order_items"]


def cycle(layers, source, run_id, as_of=AS_OF):
    return elt.Cycle(layers, source, run_id, as_of, SETTINGS)


def contents(layers):
    return {t: rows(layers.read(t)) for t in STATE}


@pytest.fixture(scope="module")
def loaded(spark, tables, tmp_path_factory):
    """Batch 1, then the rest."""
    layers = Layers(spark, str(tmp_path_factory.mktemp("layers")))
    first = cycle(layers, tables, 1).run(CUTOFF)
    second = cycle(layers, tables, 2).run()
    return layers, first, second


def test_batches_cover_the_source(loaded, tables):
    layers, first, second = loaded
    assert first > 0 and second > 0 and first + second == tables.orders.count()
    assert layers.read("raw/orders").count() == first + second
    mark = state.read_mark(layers, elt.MARK)
    assert mark == tables.orders.agg(F.max("order_purchase_timestamp")).first()[0]


def test_split_load_equals_full_load(spark, tables, loaded, tmp_path):
    """Row for row in staging and in the facts; the customer history may differ,
    because the second batch can bring a lower customer id."""
    whole = Layers(spark, str(tmp_path / "whole"))
    cycle(whole, tables, 1).run()
    for t in STATE[:3]:
        assert rows(whole.read(t)) == rows(loaded[0].read(t)), t
    natural = ["order_id", "order_item_id", "date_key", "order_status", "price",
               "delivery_days", "is_late"]
    fact = "warehouse/fact_order_items"
    assert rows(whole.read(fact), *natural) == rows(loaded[0].read(fact), *natural)


def test_rerun_changes_nothing(loaded, tables):
    layers = loaded[0]
    before = contents(layers)
    for run_id in (3, 4):
        assert cycle(layers, tables, run_id).run() == 0
        assert contents(layers) == before


def test_gates_pass_and_no_step_is_left_running(spark, loaded):
    log = run_log.read_log(spark, loaded[0].path("meta/run_log"))
    totals = run_log.steps_status(log).collect()
    assert all(r["failed"] == r["still_running"] == 0 for r in totals)
    assert {"extract.orders", "quality.staging", "load.fact", "quality.warehouse"} <= {
        r["step"] for r in log.select("step").collect()}


def test_every_fact_resolves(loaded):
    layers = loaded[0]
    d = {k: layers.read(f"warehouse/{t}") for k, t in (
        ("customer_key", "dim_customer"), ("product_key", "dim_product"),
        ("seller_key", "dim_seller"), ("geo_key", "dim_geography"),
        ("date_key", "dim_date"))}
    fact = layers.read("warehouse/fact_order_items")
    assert quality.unresolved_facts(fact, d).first()["value"] == 0


def test_bad_row_stops_the_load_and_recovery_works(spark, loaded, tables):
    layers = loaded[0]
    before = contents(layers)
    items = layers.read("staging/order_items")
    bad = spark.createDataFrame(
        [r.asDict() | {"order_item_id": 99, "price": -r["price"]} for r in
         items.orderBy("order_id", "order_item_id").limit(1).collect()], items.schema)
    layers.replace(9, "staging/order_items", items.unionByName(bad))
    with pytest.raises(quality.GateFailed, match="items.price in range: 1 = 0") as stopped:
        cycle(layers, tables, 10).run()
    assert [(n, int(v)) for n, v, _ in stopped.value.failures] == [("items.price in range", 1)]
    for t in STATE[3:]:
        assert rows(layers.read(t)) == before[t], t
    log = run_log.read_log(spark, layers.path("meta/run_log")).filter("run_id = 10")
    failed = log.filter("status = 'failed'").collect()
    assert [r["step"] for r in failed] == ["quality.staging"]
    assert "items.price in range" in failed[0]["message"]
    layers.replace(9, "staging/order_items", items)
    cycle(layers, tables, 11).run()
    assert contents(layers) == before


def test_failed_transform_is_picked_up_by_the_next_run(spark, tables, tmp_path):
    """The mark has moved, yet the landed rows are not lost."""
    layers = Layers(spark, str(tmp_path / "l"))
    broken = cycle(layers, tables, 1)
    broken.extract()
    assert cycle(layers, tables, 2).run() == 0
    assert layers.read("staging/orders").count() == tables.orders.count()
    assert layers.read("warehouse/fact_order_items").count() > 0


def test_moved_customer_is_versioned_and_old_facts_stay(spark, loaded, tables):
    layers = loaded[0]
    was = rows(layers.read("warehouse/fact_order_items"))
    before = layers.read("warehouse/dim_customer").count()
    customers = layers.read("staging/customers")
    changed = spark.createDataFrame(
        [r.asDict() | {"city": "elsewhere"} if r["customer_id"] == 0 else r.asDict()
         for r in customers.collect()], customers.schema)
    layers.replace(19, "staging/customers", changed)
    cycle(layers, tables, 20, dt.date(2002, 2, 1)).run()
    dim = layers.read("warehouse/dim_customer")
    assert dim.count() == before + 1
    assert dim.filter("customer_unique_id = 0 and is_current").first()["customer_city"] \
        == "elsewhere"
    assert rows(layers.read("warehouse/fact_order_items")) == was


def test_late_order_below_the_mark_is_not_seen_without_lookback(spark):
    from ordermill.operators.incremental import extract_orders
    orders = spark.createDataFrame([(dt.datetime(2018, 1, d),) for d in (1, 2, 3)],
                                   "order_purchase_timestamp timestamp_ntz")
    mark = dt.datetime(2018, 1, 2)
    assert extract_orders(orders, mark).count() == 1
    assert extract_orders(orders, mark, lookback=dt.timedelta(days=1)).count() == 2
    assert extract_orders(orders, dt.datetime(1970, 1, 1), mark, True).count() == 2
    assert extract_orders(orders, dt.datetime(1970, 1, 1), mark, False).count() == 1


def test_empty_source_fails_the_gate(spark, tables, tmp_path):
    nothing = SimpleNamespace(**{n: getattr(tables, n) for n in (
        "products", "translation", "sellers")}, orders=tables.orders.limit(0),
        items=tables.items, customers=tables.customers)
    with pytest.raises(quality.GateFailed, match="orders has rows"):
        cycle(Layers(spark, str(tmp_path / "e")), nothing, 1).run()


def test_publish_that_dies_loses_nothing(spark, tables, tmp_path, monkeypatch):
    """Whatever table the writing dies in, a later run ends as if it had not."""
    whole = Layers(spark, str(tmp_path / "whole"))
    cycle(whole, tables, 1).run(CUTOFF)
    once = contents(whole)
    cycle(whole, tables, 2).run()
    want = contents(whole)
    layers = Layers(spark, str(tmp_path / "broken"))
    cycle(layers, tables, 1).run(CUTOFF)
    for table in ("staging/order_items", "warehouse/dim_customer", "pointers"):
        def dies(self, *args, of=table, write=Layers.write_candidate, **kw):
            if args[1] == of:
                raise RuntimeError("executor lost")
            return write(self, *args, **kw)

        def dies_pointing(spark, path, rows, append=state.append_state):
            if path.endswith(state.POINTERS):
                raise RuntimeError("driver lost")
            append(spark, path, rows)

        with monkeypatch.context() as m:
            m.setattr(*((state, "append_state", dies_pointing) if table == "pointers"
                        else (Layers, "write_candidate", dies)))
            with pytest.raises(RuntimeError, match="lost"):
                cycle(layers, tables, 2).run()
        layers = Layers(spark, layers.root)  # a new driver
        if table in elt.STAGING:
            assert contents(layers) == once
    cycle(layers, tables, 2).run()
    assert contents(layers) == want
    assert layers.vacuum() > 0 and contents(Layers(spark, layers.root)) == want


def test_lost_folder_is_an_error(spark, tmp_path):
    from ordermill.session import delete_path
    layers = Layers(spark, str(tmp_path))
    layers.replace(1, "t", spark.range(3))
    delete_path(spark, layers.path("t"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.read("t").count()
    assert layers.read("other") is None


def test_reset_then_reload(spark, tables, tmp_path):
    layers = Layers(spark, str(tmp_path / "r"))
    cycle(layers, tables, 1).run()
    full = rows(layers.read("staging/orders"))
    elt.reset(layers, 2)
    assert layers.read("staging/orders").columns and layers.read("staging/orders").isEmpty()
    assert layers.read("warehouse/dim_customer").count() == 0
    assert state.read_mark(layers, elt.MARK) == state.EPOCH
    assert cycle(layers, tables, 3).run() == tables.orders.count()
    assert rows(layers.read("staging/orders")) == full


def test_stream_in_small_batches_equals_batch(spark, tables, tmp_path):
    from ordermill.streaming.ingest import StreamSource, ingest_available
    source = tmp_path / "in"
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for i in range(3):
        part = orders.filter(F.pmod("o_orderkey", F.lit(3)) == i)
        part.toPandas().to_parquet(_ensure(source / "orders.parquet") / f"part-{i}.parquet",
                                   index=False, coerce_timestamps="us")
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    for _ in range(2):                      # the second start finds nothing new
        ingest_available(StreamSource(spark, str(source), 1).raw_orders, landing,
                         checkpoint)
    landed = spark.read.parquet(landing)
    assert landed.select("_run_id").distinct().count() >= 3
    assert rows(staging.stage_orders(landed.drop("_run_id"))[0]) == rows(
        staging.stage_orders(tables.raw_orders)[0])


def _ensure(path):
    path.mkdir(parents=True, exist_ok=True)
    return path


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_marks_do_not_depend_on_the_session_zone(spark, zone):
    from ordermill.operators.incremental import extract_orders, with_lineage
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        orders = spark.sql("select explode(array(timestamp_ntz'2018-01-01 00:00:00', "
                           "timestamp_ntz'2018-01-01 03:00:00')) as order_purchase_timestamp")
        mark = dt.datetime(2018, 1, 1)
        assert extract_orders(orders, mark).count() == 1
        assert extract_orders(orders, dt.datetime(1970, 1, 1), mark, True).count() == 1
        assert {r[0] for r in with_lineage(orders, 1, mark).select("_extracted_at")
                .collect()} == {mark}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
