"""Merging cleaned rows into the versioned staging tables.

Used by the batch cycle and by the streams. Each merge reads and rewrites the
partitions of its rows only and leaves a candidate; nothing is published here.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality, staging
from ..operators.merge import upsert_update
from ..sources.layers import Layers

STAGING = ["staging/customers", "staging/orders", "staging/order_items"]
#: Names of the staging tables in the declared rules.
RULES = {"staging/customers": "customers", "staging/orders": "orders",
         "staging/order_items": "items"}
ORPHANS = "0"


def period(year: Column, month: Column, months: int) -> Column:
    """First month of the period as yyyyMM: partition value of the large tables."""
    return (year * 100 + 1 + F.floor((month - 1) / months) * months).cast("int")


@dataclass
class StagingMerge:
    layers: Layers
    run_id: int
    checks: Sequence[quality.Check]
    months: int = 1
    update_transit_dates: bool = True
    fixed_identity: bool = False    # see Settings

    def _checks(self, table: str) -> list[quality.Check]:
        return [c for c in self.checks if c.table == RULES[table]
                and not isinstance(c.value, quality.Reference)]

    def customers(self, rows: DataFrame) -> None:
        """``rows`` is read several times: give a written table."""
        table = "staging/customers"
        parts = set(self.layers.parts_of(table, rows))
        if not self.fixed_identity:
            parts |= set(self.layers.parts_of(table, self._known(
                table, rows, ["customer_id"], ["customer_id", "customer_unique_id"])))
        old = self.layers.read(table, rows, sorted(parts))
        self.layers.write_candidate(
            self.run_id, table, upsert_update(old, rows, ["customer_id"],
                                              staging.CUSTOMER_UPDATES),
            replaces=parts, checks=self._checks(table))

    def with_period(self, orders: DataFrame) -> DataFrame:
        placed = F.col("order_purchase_timestamp")
        return orders.withColumn("purchase_period", period(
            F.year(placed), F.month(placed), self.months))

    def orders(self, rows: DataFrame) -> None:
        """Rows with their period, a written table. An order already staged stays in
        the period it was first placed in."""
        table = "staging/orders"
        parts = set(self.layers.parts_of(table, rows))
        if not self.fixed_identity:
            parts |= set(self.layers.parts_of(table, self._known(
                table, rows, ["order_id"], ["order_id", "purchase_period"])))
        update = (staging.ORDER_UPDATES if self.update_transit_dates
                  else staging.ORDER_UPDATES_SLIM)
        old = self.layers.read(table, rows, sorted(parts))
        self.layers.write_candidate(
            self.run_id, table, upsert_update(old, rows, ["order_id"], update),
            checks=self._checks(table))

    def items(self, rows: DataFrame, orders: DataFrame) -> None:
        """Items lie in the period of their order, which is looked up in ``orders``;
        those without one wait in a partition of their own, where the gate finds them,
        and move when their order comes. ``rows`` is a written table."""
        table, keys = "staging/order_items", ["order_id", "order_item_id"]
        plain = rows.columns
        like = rows.withColumn("purchase_period", F.lit(0))
        waiting = self.layers.read(table, like, [ORPHANS]).select(plain)
        placed = upsert_update(waiting, rows, keys, staging.ITEM_UPDATES).join(
            orders.select("order_id", "purchase_period"), "order_id", "left").withColumn(
            "purchase_period", F.coalesce("purchase_period", F.lit(int(ORPHANS))))
        placed = self.layers.write_candidate(self.run_id, "_work/placed_items", placed)
        parts = [p for p in self.layers.parts_of(table, placed) if p != ORPHANS]
        old = self.layers.read(table, like, parts)
        # References are measured where items and their orders lie, period by period.
        self.layers.write_candidate(
            self.run_id, table, upsert_update(old, placed, keys, staging.ITEM_UPDATES),
            replaces=[ORPHANS], checks=self.item_checks(orders))

    def item_checks(self, orders: DataFrame) -> list[quality.Check]:
        return quality.bound([c for c in self.checks if c.table == "items"],
                             {"orders": orders})

    def _known(self, table: str, rows: DataFrame, keys: list[str],
               columns: list[str]) -> DataFrame:
        """Where the incoming keys are staged already: a look at key columns only."""
        old = self.layers.read(table, rows)
        return old.select(*columns).join(rows.select(*keys), keys, "left_semi")

    def states(self) -> dict[str, dict]:
        """States of the staging tables after publishing, by their names in the rules."""
        def parents() -> dict[str, DataFrame]:
            return {"orders": self.layers.preview(self.run_id, "staging/orders")}

        return {name: self.layers.states(
            self.run_id, table, [c for c in self.checks if c.table == name], parents)
            for table, name in RULES.items()}
