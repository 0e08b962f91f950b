"""The marts as a step of the cycle: touched periods rebuilt, gated, published.

- Revenue: days of the touched periods are summed anew from their facts. The
  average over seven sales days reaches back into earlier periods and on into later
  ones: the last six sales days of each category and state are kept per period, and
  later periods come from the mart itself. Only periods with a row whose average
  can have changed are written.
- Delivery: a row belongs to one month, so touched periods are rebuilt.
- Cohorts: a person's months of activity lie in a bucket by person. Buckets with a
  person of the touched periods, as they were or as they are, are counted again; the
  counts of all buckets add up to the mart.

Where a known member of a dimension got another category or state, all periods are
touched, as a full build would show it in all of them.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import differs
from ..operators import quality
from ..operators.fact import enrich
from ..operators.run_log import RunLog
from ..operators.windows import rolling_rows
from ..schemas import MART_RULES
from ..sources.layers import Layers
from . import marts
from .staging_merge import period

FACT = "warehouse/fact_order_items"
REVENUE, DELIVERY, COHORTS = ("marts/revenue_daily", "marts/delivery_performance",
                              "marts/customer_cohorts")
LAST_DAYS, PERSON_MONTHS, COHORT_PARTS = ("marts/last_days", "marts/person_months",
                                          "marts/cohort_parts")
TABLES = [REVENUE, DELIVERY, COHORTS, LAST_DAYS, PERSON_MONTHS, COHORT_PARTS]
#: Attributes of known members that the marts show.
SHOWN = {"warehouse/dim_product": ("product_key", "category_en"),
         "warehouse/dim_seller": ("seller_key", "seller_state"),
         "warehouse/dim_geography": ("geo_key", "state"),
         "warehouse/dim_customer": ("customer_key", "customer_unique_id")}
WINDOW = 7


def sold_money() -> quality.Check:
    """Figure of the facts that the revenue mart has to meet."""
    return quality.Check("sold", "fact", F.coalesce(F.sum(F.when(
        F.col("order_status") != "canceled", F.col("price"))), F.lit(0)), "value >= 0")


def shown_money() -> quality.Check:
    return quality.Check("revenue", "revenue", F.coalesce(F.sum(
        F.col("revenue").cast("decimal(20,2)")), F.lit(0)), "value >= 0")


def delivery_checks() -> list[quality.Check]:
    return [*quality.constraint_checks("delivery", (), MART_RULES["delivery"]),
            quality.Check("late within delivered", "delivery", quality.violations(
                F.col("late_items") > F.col("delivered_items")))]


def cohort_checks() -> list[quality.Check]:
    return [*quality.constraint_checks("cohorts", (), MART_RULES["cohorts"]),
            quality.Check("first month is whole", "cohorts", quality.violations(
                (F.col("month_offset") == 0) & (F.col("retention_pct") != 100)))]


@dataclass
class MartStep:
    layers: Layers
    run_id: int
    log: RunLog
    months: int = 1

    def run(self) -> None:
        changed = self.layers.unseen("marts", FACT)
        moved = {t: self.layers.unseen("marts", t) for t in SHOWN}
        periods = set(changed)
        if any(self._shown_changes(t, p) for t, p in moved.items()):
            periods |= set(self.layers.published_parts(FACT))
        if periods:
            self._build(sorted(periods, key=int), changed)
        with self.log.step("quality.marts") as c:
            figures = self._figures()
            c["rows_in"] = len(figures)
            c["rows_out"] = quality.judge("marts", figures)
        seen = {f"marts/{t}": {p: self.layers.published_parts(t).get(p) for p in parts}
                for t, parts in {FACT: changed, **moved}.items() if parts}
        self.layers.publish(self.run_id, TABLES, seen=seen)
        self.layers.drop_work()

    def _shown_changes(self, table: str, parts: dict) -> bool:
        """Whether a member that was there before shows something else now."""
        was = [f for f in parts.values() if f is not None]
        if not was:
            return False
        key, column = SHOWN[table]
        old = self.layers.seen_frame(table, was).select(key, F.col(column).alias("_was"))
        new = self.layers.read(table, parts=parts).select(key, column)
        return not new.join(old, key).filter(differs(
            (F.col(column), F.col("_was")))).isEmpty()

    def _enriched(self, fact: DataFrame, wanted: Sequence[str]) -> DataFrame:
        return enrich(fact, {SHOWN[t][0]: self.layers.read(t) for t in SHOWN}, wanted)

    def _period(self):
        return period(F.col("year"), F.col("month"), self.months)

    def _build(self, periods: list[str], changed: dict) -> None:
        fact = self.layers.read(FACT, parts=periods)
        for step, build in (
                ("marts.revenue_daily", lambda: self._revenue(fact, periods)),
                ("marts.delivery_performance", lambda: self._delivery(fact, periods)),
                ("marts.customer_cohorts", lambda: self._cohorts(fact, periods, changed))):
            with self.log.step(step) as c:
                c["rows_out"] = build()

    # ---- revenue ---------------------------------------------------------

    def _revenue(self, fact: DataFrame, periods: list[str]) -> int:
        layers, group = self.layers, list(marts.REVENUE_NEEDS)
        days = marts.daily_sales(self._enriched(fact, marts.REVENUE_NEEDS))
        days = days.withColumns({"revenue": F.col("revenue").cast("double"),
                                 "purchase_period": self._period()})
        known = layers.published_parts(REVENUE)
        first = int(periods[0])
        later = [p for p in known if int(p) > first and p not in periods]
        base = days.unionByName(layers.read(REVENUE, days, later).select(*days.columns))
        before = [p for p in layers.published_parts(LAST_DAYS) if int(p) < first]
        if before:
            base = base.unionByName(layers.read(
                LAST_DAYS, parts=[max(before, key=int)]).select(
                *[c for c in days.columns if c != "purchase_period"],
                F.col("own_period").alias("purchase_period")))
        in_order = Window.partitionBy(*group).orderBy("order_date")
        # Read three times: the periods to write, their rows, and the days kept.
        rolled = layers.write_candidate(self.run_id, "_work/rolled", self._reached(
            rolling_rows(base, group, "order_date", "revenue", WINDOW), periods).withColumn(
            "_then", F.lead("purchase_period", WINDOW - 1).over(in_order)))
        current = F.col("purchase_period") >= first
        affected = set(periods) | self._periods_of(rolled.filter(current & F.col("_reached")))
        published = layers.read(REVENUE, parts=[p for p in known if int(p) >= first])
        if published is not None:
            affected |= self._periods_of(self._reached(published, periods).filter("_reached"))
        columns = [c for c in rolled.columns if c not in ("_reached", "_then")]
        layers.write_candidate(
            self.run_id, REVENUE, rolled.filter(current & F.col("purchase_period").isin(
                [int(p) for p in affected])).select(*columns), affected, [shown_money()])

        kept = sorted({int(p) for p in [*known, *periods] if int(p) >= first})
        for_periods = F.filter(
            F.array(*map(F.lit, kept)), lambda p: (p >= F.col("purchase_period"))
            & (F.col("_then").isNull() | (p < F.col("_then"))))
        layers.write_candidate(self.run_id, LAST_DAYS, rolled.select(
            *[c for c in days.columns if c != "purchase_period"],
            F.col("purchase_period").alias("own_period"),
            F.explode(for_periods).alias("purchase_period")), kept)
        return layers.rows(self.run_id, REVENUE, affected)

    def _reached(self, days: DataFrame, periods: list[str]) -> DataFrame:
        """Whether a day of the touched periods is within a row's window."""
        w = (Window.partitionBy(*marts.REVENUE_NEEDS).orderBy("order_date")
             .rowsBetween(1 - WINDOW, 0))
        inside = F.col("purchase_period").isin([int(p) for p in periods])
        return days.withColumn("_reached", F.max(inside).over(w))

    def _periods_of(self, days: DataFrame) -> set[str]:
        return set(self.layers.parts_of(REVENUE, days))

    # ---- delivery ----------------------------------------------------------

    def _delivery(self, fact: DataFrame, periods: list[str]) -> int:
        rows = marts.delivery_performance(self._enriched(fact, marts.DELIVERY_NEEDS))
        self.layers.write_candidate(
            self.run_id, DELIVERY, rows.withColumn("purchase_period", self._period()),
            periods, delivery_checks())
        return self.layers.rows(self.run_id, DELIVERY, periods)

    # ---- cohorts -----------------------------------------------------------

    def _cohorts(self, fact: DataFrame, periods: list[str], changed: dict) -> int:
        layers, person = self.layers, marts.COHORT_NEEDS
        fresh = marts.person_months(self._enriched(fact, person)).withColumn(
            "purchase_period", period(F.year("active_month"), F.month("active_month"),
                                      self.months))
        fresh = layers.write_candidate(self.run_id, "_work/person_months", fresh)
        buckets = set(layers.parts_of(PERSON_MONTHS, fresh))
        was = [f for f in changed.values() if f is not None]
        if was:
            gone = marts.sold(self._enriched(layers.seen_frame(FACT, was), person))
            buckets |= set(layers.parts_of(PERSON_MONTHS, gone.select(*person)))
        others = layers.read(PERSON_MONTHS, fresh, buckets).filter(
            ~F.col("purchase_period").isin([int(p) for p in periods]))
        layers.write_candidate(self.run_id, PERSON_MONTHS, others.unionByName(fresh), buckets)
        active = layers.preview(self.run_id, PERSON_MONTHS, buckets).withColumn(
            "bucket", layers.part_column(PERSON_MONTHS))
        layers.write_candidate(self.run_id, COHORT_PARTS,
                               marts.cohort_counts(active, by=["bucket"]), buckets)
        counts = layers.preview(self.run_id, COHORT_PARTS).groupBy(
            "cohort_month", "month_offset").agg(
            F.sum("customers").alias("customers"), F.sum("orders").alias("orders"))
        layers.write_candidate(self.run_id, COHORTS, marts.with_retention(counts), (),
                               cohort_checks())
        return layers.rows(self.run_id, COHORTS)

    # ---- gate --------------------------------------------------------------

    def _figures(self) -> list[tuple[str, Decimal, str]]:
        """Revenue against the facts, and bounds of percentages, from the states."""
        figures = [(c.name, quality.merged(c, {c.table: self.layers.states(
            self.run_id, table, of)}), c.passes)
            for table, of in ((DELIVERY, delivery_checks()), (COHORTS, cohort_checks()))
            for c in of]
        totals = [quality.merged(c, {c.table: self.layers.states(self.run_id, table, [c])})
                  for table, c in ((FACT, sold_money()), (REVENUE, shown_money()))]
        return [*figures, ("revenue less that of the facts", abs(totals[1] - totals[0]),
                           "value < 1")]
