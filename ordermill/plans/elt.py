"""One incremental cycle: extract, transform, gate, load, gate, marts, publish.

Stages hand over written tables. Only what a run touches is read and rewritten:
pending raw rows, the periods their orders fall into, and the hash buckets of the
customers and dimension members that are new or changed. Gates merge the figures
kept with the partitions that were not touched. A run that stopped between two
stages is picked up by the next one, because pending work is derived from what was
published and what each stage has seen of it, not from the run at hand.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import differs
from ..operators import dimensions as dims
from ..operators import incremental as inc
from ..operators import quality, staging
from ..operators.fact import FACT_COLUMNS, build_fact
from ..operators.keys import extend_keys
from ..operators.merge import upsert_ignore, upsert_update
from ..operators.run_log import RunLog, utc_now
from ..operators.scd2 import change_counts, one_address_per_person, scd2_merge
from ..schemas import CALENDAR_END, CALENDAR_START, FIRST_VALID_FROM
from ..session import delete_path
from ..sources import layers as state
from ..sources.layers import SEEN, Layers
from . import mart_layers
from .staging_merge import ORPHANS, STAGING, StagingMerge, period

MARK = "raw.orders"
RAW = ["raw/orders", "raw/order_items", "raw/customers"]
WAREHOUSE = ["warehouse/dim_date", "warehouse/dim_product", "warehouse/dim_seller",
             "warehouse/dim_geography", "warehouse/dim_customer",
             "warehouse/fact_order_items"]
MARTS = ["marts/revenue_daily", "marts/delivery_performance", "marts/customer_cohorts"]
FACT = "warehouse/fact_order_items"


@dataclass(frozen=True)
class Settings:
    """Behaviours in which the two generations of the reference differ, and sizes."""
    inclusive_max_ts: bool = False          # upper bound of the extract
    seller_zips: bool = True                # sellers' zips in dim_geography
    unknown_geography: bool = False         # left join and -1, or inner join
    leading_zero_check: bool = True
    no_unknown_check: bool = False
    update_transit_dates: bool = True       # approved/carrier dates on conflict
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END)
    first_valid_from: str = FIRST_VALID_FROM
    months_per_partition: int = 1           # more where a month is small
    # True where a source never changes an order's purchase time or a customer's
    # person: the key columns of older periods and buckets are then not looked at.
    fixed_identity: bool = False
    marts: bool = True


@dataclass
class Cycle:
    layers: Layers
    source: object            # orders, items, customers, products, translation, sellers
    run_id: int
    as_of: dt.date
    settings: Settings = Settings()
    clock: Callable[[], dt.datetime] = utc_now

    def __post_init__(self):
        self.spark = self.layers.spark
        self.log = RunLog(self.spark, self.layers.path("meta/run_log"), self.run_id,
                          self.clock)
        cfg = self.settings
        self.staging_checks = quality.staging_checks(cfg.leading_zero_check)
        self.merge = StagingMerge(self.layers, self.run_id, self.staging_checks,
                                  cfg.months_per_partition, cfg.update_transit_dates,
                                  cfg.fixed_identity)

    def run(self, max_ts: dt.datetime | None = None) -> int:
        """Returns the number of extracted orders."""
        extracted = self.extract(max_ts)
        self.transform()
        self.load()
        if self.settings.marts:
            mart_layers.MartStep(self.layers, self.run_id, self.log,
                                 self.settings.months_per_partition).run()
        self.log.compact()
        self.layers.compact()
        return extracted

    # ---- source -> raw ---------------------------------------------------

    def extract(self, max_ts: dt.datetime | None = None) -> int:
        mark = state.read_mark(self.layers, MARK)
        with self.log.step("extract.orders") as c:
            fresh = inc.extract_orders(self.source.orders, mark, max_ts,
                                       self.settings.inclusive_max_ts)
            orders, seen = self._land("raw/orders", fresh,
                                      F.max("order_purchase_timestamp").alias("top"))
            c["rows_in"] = c["rows_out"] = seen["rows"]
        with self.log.step("extract.children") as c:
            landed = 0
            for table, children, key in (
                    ("raw/order_items", self.source.items, "order_id"),
                    ("raw/customers", self.source.customers, "customer_id")):
                # Without orders there are no children: the source isn't looked through.
                found = (inc.extract_children(children, orders, key) if seen["rows"]
                         else children.limit(0))
                _, n = self._land(table, found)
                landed += n["rows"]
            c["rows_out"] = landed
        # A run id that is used again has to be staged again.
        noted = {"staging/raw": {str(self.run_id): None}}
        if seen["top"] is not None:
            self.layers.publish(self.run_id, [], seen=noted | state.mark(MARK, seen["top"]))
        return seen["rows"]

    def _land(self, table: str, df: DataFrame, *figures: Column) -> tuple[DataFrame, dict]:
        """The rows as landed, and their number, taken while they are written."""
        seen = Observation()
        landed = inc.with_lineage(df, self.run_id, self.clock())
        self.layers.append_run(table, landed.observe(
            seen, F.count(F.lit(1)).alias("rows"), *figures))
        back = self.layers.landed_of(table, [self.run_id], landed.drop("_run_id").schema)
        return back, {"rows": 0, "top": None} | seen.get

    # ---- raw -> staging --------------------------------------------------

    def transform(self) -> None:
        done = self.layers.published_parts(f"{SEEN}staging/raw")
        runs = [r for r in self.layers.landed_runs("raw/orders") if str(r) not in done]
        if runs:
            with self.log.step("transform.customers") as c:
                self.merge.customers(self._cleaned(c, "customers", runs))
                c["rows_out"] = self.layers.rows(self.run_id, "staging/customers")
            with self.log.step("transform.orders") as c:
                self.merge.orders(self._cleaned(c, "orders", runs))
                c["rows_out"] = self._written("staging/orders")
            with self.log.step("transform.order_items") as c:
                self.merge.items(self._cleaned(c, "order_items", runs),
                                 self.layers.candidate(self.run_id, "staging/orders"))
                c["rows_out"] = self._written("staging/order_items")
        with self.log.step("quality.staging") as c:
            c["rows_in"] = len(self.staging_checks)
            c["rows_out"] = quality.gate(self.staging_checks, self.merge.states(), "staging")
        if runs:
            self.layers.publish(self.run_id, STAGING, seen={
                "staging/raw": {str(r): "staged" for r in runs}})
        self.layers.drop_work()

    def _cleaned(self, counters: dict, table: str, runs: Sequence[int]) -> DataFrame:
        """Cleaned rows of the pending runs, written once: merges read them repeatedly."""
        sources = {"customers": self.source.customers, "orders": self.source.orders,
                   "order_items": self.source.items}
        columns = inc.with_lineage(sources[table], 0, state.EPOCH).drop("_run_id").schema
        seen = Observation()
        raw = self.layers.landed_of(f"raw/{table}", runs, columns).observe(
            seen, F.count(F.lit(1)).alias("rows"),
            F.count_if(~staging.accepted(table)).alias("rejected"))
        rows, _ = {"customers": staging.stage_customers, "orders": staging.stage_orders,
                   "order_items": staging.stage_items}[table](raw)
        if table == "orders":
            rows = self.merge.with_period(rows)
        back = self.layers.write_candidate(self.run_id, f"_work/{table}", rows)
        counters["rows_in"] = seen.get.get("rows", 0)
        counters["rows_rejected"] = seen.get.get("rejected", 0)
        return back

    def _written(self, table: str) -> int:
        return self.layers.rows(self.run_id, table, self.layers.touched(self.run_id, table))

    # ---- staging -> warehouse --------------------------------------------

    def load(self) -> None:
        src, cfg, layers = self.source, self.settings, self.layers
        before = {t: layers.unseen("load", t) for t in STAGING}
        moved = before["staging/customers"]
        self._dimension("dim_date", self._calendar(), "date_key", None, [])
        product = dims.dim_product(src.products, src.translation)
        self._dimension("dim_product", product, "product_id", "product_key",
                        product.columns[1:])
        seller = dims.dim_seller(src.sellers)
        self._dimension("dim_seller", seller, "seller_id", "seller_key",
                        seller.columns[1:])
        customers = layers.read("staging/customers", parts=moved)
        self._geography(customers, moved)
        versioned = self._customer_history(customers, moved)

        with self.log.step("load.fact") as c:
            periods = self._periods_to_load(before, customers, versioned)
            if periods:
                c["rows_in"], c["rows_out"] = self._fact(periods)
        checks = quality.warehouse_checks(cfg.no_unknown_check)
        with self.log.step("quality.warehouse") as c:
            states = {
                "fact": layers.states(
                    self.run_id, FACT, [x for x in checks if x.table == "fact"],
                    lambda: {"dim_customer": self._view("dim_customer")}),
                "dim_customer": layers.states(self.run_id, "warehouse/dim_customer", [
                    x for x in checks if x.table == "dim_customer"]),
                "items": layers.states(self.run_id, "staging/order_items")}
            c["rows_in"] = len(checks)
            c["rows_out"] = quality.gate(checks, states, "warehouse")
        now = {t: layers.published_parts(t) for t in STAGING}
        seen = {f"load/{t}": {p: now[t].get(p) for p in parts}
                for t, parts in before.items() if parts}
        layers.publish(self.run_id, WAREHOUSE, seen=seen)
        layers.drop_work()

    def _calendar(self) -> DataFrame:
        lo, hi = (F.lit(d).cast("date") for d in self.settings.calendar)
        return dims.dim_date(self.spark.range(1).select(lo.alias("lo"), hi.alias("hi")))

    def _dimension(self, name: str, rows: DataFrame, natural: str, key: str | None,
                   update: list[str]) -> None:
        """Merge a dimension by natural key; known rows keep their surrogate.

        The source tells no changes, so it is digested bucket by bucket in one pass;
        buckets whose digest is the one kept with them are left alone.
        """
        table = f"warehouse/{name}"
        with self.log.step(f"load.{name}") as c:
            version = self.layers.next_version(self.run_id, table)
            kept = version.states if version else {}
            digests = self._digests(table, rows)
            parts = [p for p, d in digests.items() if kept.get(p, {}).get("source") != d]
            if parts or version is None:
                like = rows
                if table in self.layers.parts:
                    rows = rows.filter(self.layers.part_column(table).isin(parts))
                if key:
                    rows = rows.withColumn(key, F.lit(None).cast("long")).select(
                        key, *rows.columns)
                    like = rows
                old = self.layers.read(table, like, parts)
                merged = (upsert_update(old, rows, [natural], update) if update
                          else upsert_ignore(old, rows, [natural]))
                self._write_dimension(name, merged, natural, key)
                for p in parts:
                    self.layers.note(self.run_id, table, p, "source", digests[p])
            c["rows_out"] = self.layers.rows(self.run_id, table)

    def _write_dimension(self, name: str, merged: DataFrame, natural: str, key: str | None,
                         replaces: Sequence[str] = ()) -> None:
        table, checks = f"warehouse/{name}", []
        if name == "dim_customer":
            checks = [x for x in quality.warehouse_checks() if x.table == name]
        if key:
            # Written once: numbering the new rows reads them several times.
            merged = self.layers.write_candidate(self.run_id, f"_work/{name}", merged)
            top = quality.Check("top key", name, quality.Highest(key))
            highest = int(quality.merged(top, {name: self.layers.states(
                self.run_id, table, [top])}))
            merged = extend_keys(None, merged, natural, key, highest)
            checks = [*checks, top]
        self.layers.write_candidate(self.run_id, table, merged, replaces, checks)

    def _digests(self, table: str, rows: DataFrame) -> dict[str, str]:
        """Number and hashes of the source rows of each bucket of a table."""
        part = self.layers.part_column(table) if table in self.layers.parts else F.lit("")
        one, two = F.xxhash64(*rows.columns), F.xxhash64(F.lit(1), *rows.columns)
        found = rows.groupBy(part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("s"),
            F.bit_xor(two).alias("x")).collect()
        return {r["part"]: f"{r['n']}/{r['s']}/{r['x']}" for r in found}

    def _geography(self, customers: DataFrame, moved: dict) -> None:
        """Zips of the customers at hand and of the sellers; known ones stay."""
        table = "warehouse/dim_geography"
        with self.log.step("load.dim_geography") as c:
            sellers, known = self.source.sellers, self.layers.published_parts(table)
            if not (self.settings.seller_zips
                    and self.layers.touched(self.run_id, "warehouse/dim_seller")):
                if known and not moved:
                    c["rows_out"] = self.layers.rows(self.run_id, table)
                    return
                sellers = sellers.limit(0)
            places = dims.zip_places(customers.select(
                F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
                F.col("city").alias("customer_city"), F.col("state").alias("customer_state")),
                sellers)
            like = places.select(F.lit(None).cast("long").alias("geo_key"), "*")
            fresh = like
            if self.settings.unknown_geography:
                fresh = like.unionByName(dims.unknown_geography(like))
            known = self.layers.read(table, like, self.layers.parts_of(table, fresh))
            fresh = self.layers.write_candidate(self.run_id, "_work/places", fresh.join(
                known.select("zip_code_prefix"), "zip_code_prefix", "left_anti")
                .select(*like.columns))
            parts = self.layers.parts_of(table, fresh)
            if parts or self.layers.next_version(self.run_id, table) is None:
                self._write_dimension("dim_geography", self.layers.read(
                    table, like, parts).unionByName(fresh), "zip_code_prefix", "geo_key")
            c["rows_out"] = self.layers.rows(self.run_id, table)

    def _customer_history(self, customers: DataFrame, parts: dict) -> int:
        """The history of the persons in these buckets; how many got a new version."""
        table = "warehouse/dim_customer"
        with self.log.step("load.dim_customer") as c:
            c["rows_out"] = 0
            if not parts and self.layers.next_version(self.run_id, table) is not None:
                return 0
            first = dims.dim_customer_initial(customers.select(
                "customer_unique_id", "customer_id",
                F.col("city").alias("customer_city"),
                F.col("state").alias("customer_state"),
                F.col("zip_code_prefix").alias("customer_zip_code_prefix")), None)
            like = first.select(F.lit(None).cast("long").alias("customer_key"), "*")
            old = self.layers.read(table, like, parts)
            merged = self.layers.write_candidate(
                self.run_id, "_work/dim_customer_changes",
                scd2_merge(old, one_address_per_person(customers), self.as_of,
                           self.settings.first_valid_from))
            n = change_counts(merged).first()
            self._write_dimension("dim_customer", merged.drop("change"),
                                  "customer_unique_id", "customer_key")
            c["rows_out"] = n["versioned"] + n["new"]
            c["rows_rejected"] = n["expired"] + n["corrected"]
            return n["versioned"]

    def _periods_to_load(self, before: dict, customers: DataFrame, versioned: int
                         ) -> list[str]:
        """Periods with new rows, and earlier ones whose facts resolve differently now:
        those of customers with another zip or person, and those on or after the day
        from which a new version holds."""
        layers = self.layers
        periods = {p for t in STAGING[1:] for p in before[t]} - {ORPHANS}
        loaded = set(layers.published_parts(FACT))
        moved = before["staging/customers"]
        was = [f for f in moved.values() if f is not None]
        if was and loaded:
            old = layers.seen_frame("staging/customers", was).select(
                "customer_id", F.col("customer_unique_id").alias("_person"),
                F.col("zip_code_prefix").alias("_zip"))
            changed = customers.join(old, "customer_id").filter(differs(
                (F.col("customer_unique_id"), F.col("_person")),
                (F.col("zip_code_prefix"), F.col("_zip")))).select("customer_id")
            changed = layers.write_candidate(self.run_id, "_work/changed", changed)
            if not changed.isEmpty():
                orders = layers.read("staging/orders").select("customer_id", "purchase_period")
                periods |= set(layers.parts_of("staging/orders", orders.join(
                    changed, "customer_id", "left_semi")))
        if versioned:
            first = layers.parts_of("staging/orders", self.spark.range(1).select(period(
                F.lit(self.as_of.year), F.lit(self.as_of.month),
                self.settings.months_per_partition).alias("purchase_period")))[0]
            periods |= {p for p in loaded if int(p) >= int(first)}
        return sorted(periods)

    def _fact(self, periods: Sequence[str]) -> tuple[int, int]:
        layers, cfg = self.layers, self.settings
        view = {t: self._view(t) for t in ("dim_customer", "dim_product", "dim_seller",
                                           "dim_geography")}
        fact = build_fact(
            layers.read("staging/order_items", parts=periods),
            layers.read("staging/orders", parts=periods), layers.read("staging/customers"),
            **view, unknown_geography=cfg.unknown_geography)
        fact = fact.select(*FACT_COLUMNS, period(
            F.expr("date_key div 10000"), F.expr("date_key div 100 % 100"),
            cfg.months_per_partition).alias("purchase_period"))
        checks = quality.bound([x for x in quality.warehouse_checks(cfg.no_unknown_check)
                                if x.table == "fact"], {"dim_customer": view["dim_customer"]})
        checks.append(mart_layers.sold_money())
        layers.write_candidate(self.run_id, FACT, fact, periods, checks)
        return (layers.rows(self.run_id, "staging/order_items", periods),
                layers.rows(self.run_id, FACT, periods))

    def _view(self, name: str) -> DataFrame:
        return self.layers.preview(self.run_id, f"warehouse/{name}")


def layer_counts(layers: Layers) -> DataFrame:
    """Rows of every published layer table."""
    out = None
    for table in ("raw/orders", *STAGING, *WAREHOUSE):
        df = layers.read(table)
        if df is not None:
            row = df.agg(F.count("*").alias("rows")).select(
                F.lit(table).alias("table"), "rows")
            out = row if out is None else out.unionByName(row)
    return out


def reset(layers: Layers, run_id: int) -> None:
    """Empty every layer but keep schemas and the unknown member; forget the mark.

    One file of pointers does it all: tables point at empty versions, marks and what
    was seen are gone, and the landed runs count as staged. Only then is the landing
    removed; a reset that dies before that leaves files that nothing reads.
    """
    cleared, forget = [], {}
    for table in (*STAGING, *WAREHOUSE, *mart_layers.TABLES):
        df = layers.read(table)
        if df is not None:
            layers.write_candidate(run_id, table, df.filter("geo_key = -1")
                                   if table.endswith("dim_geography") else df.limit(0))
            cleared.append(table)
    for step, tables in (("load", STAGING), ("marts", [FACT])):
        for t in tables:
            gone = layers.published_parts(f"{SEEN}{step}/{t}")
            forget[f"{step}/{t}"] = dict.fromkeys(gone)
    runs = layers.landed_runs("raw/orders")
    layers.publish(run_id, cleared, whole=True, seen=forget | state.mark(MARK, None) | {
        "staging/raw": {str(r): "reset" for r in runs}})
    for table in RAW:
        delete_path(layers.spark, layers.path(table))
