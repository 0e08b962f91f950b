"""Step log of the load runs, and reports over it.

A step writes one row when it starts and one when it ends; readers take the
last row per (run, step). The log is independent of the data writes, so a
failed step is still recorded.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import seconds_between
from ..session import append_state, compact_state
from .dedup import first_per_key

LOG_DDL = ("run_id long, step string, started_at timestamp_ntz, "
           "ended_at timestamp_ntz, rows_in long, rows_out long, rows_rejected long, "
           "status string, message string, seq long")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Step:
    """A step while it runs: a mapping of its counts, recorded when it begins and ends."""

    def __init__(self, log: RunLog, name: str):
        self.log, self.name, self.started = log, name, log.clock()
        self.counts: dict = dict(rows_in=None, rows_out=None, rows_rejected=0)

    def __setitem__(self, count: str, value: int) -> None:
        self.counts[count] = value

    def __enter__(self) -> Step:
        self._record("running")
        return self

    def __exit__(self, kind, error, trace) -> None:
        # The whole message: a gate may have failed in many checks.
        self._record("failed" if error else "success", self.log.clock(),
                     str(error) if error else None)

    def _record(self, status: str, ended: dt.datetime | None = None,
                message: str | None = None) -> None:
        self.log.seq += 1
        append_state(self.log.spark, self.log.path, [dict(
            self.counts, run_id=self.log.run_id, step=self.name, started_at=self.started,
            ended_at=ended, status=status, message=message, seq=self.log.seq)])


class RunLog:
    """Where the steps of one run are recorded."""

    def __init__(self, spark: SparkSession, path: str, run_id: int,
                 clock: Callable[[], dt.datetime] = utc_now):
        self.spark, self.path, self.run_id, self.clock, self.seq = spark, path, run_id, clock, 0

    def step(self, name: str) -> Step:
        return Step(self, name)

    def compact(self, files: int = 100) -> None:
        """Keep the last row of each step, in one file, where there are more than
        ``files``."""
        compact_state(self.spark, self.path, lambda: first_per_key(
            self.spark.read.schema(LOG_DDL).json(self.path), ["run_id", "step"],
            [F.desc("started_at"), F.desc("seq")]), files)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Current state of each (run, step)."""
    log = spark.read.schema(LOG_DDL).json(path)
    return first_per_key(log, ["run_id", "step"],
                         [F.desc("started_at"), F.desc("seq")]).drop("seq")


def run_report(log: DataFrame, last: int = 40) -> DataFrame:
    """The latest steps with their duration and a shortened message."""
    def n(c: str):
        return F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    elapsed = seconds_between(F.col("started_at"), F.col("ended_at"))
    return (log.orderBy(F.desc("started_at"), F.desc("run_id"), F.desc("step"))
            .limit(last)
            .select("run_id", "step", "status", n("rows_in"), n("rows_out"),
                    n("rows_rejected"), F.round(elapsed, 2).cast("double").alias("secs"),
                    F.left(F.coalesce("message", F.lit("")), F.lit(46)).alias("message")))


def status_totals(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("steps"))


def steps_status(log: DataFrame) -> DataFrame:
    """Succeeded, failed and unfinished steps of each run."""
    def n(s: str):
        return F.count_if(F.col("status") == s)
    return log.groupBy("run_id").agg(
        F.count("*").alias("steps"), n("success").alias("succeeded"),
        n("failed").alias("failed"), n("running").alias("still_running"))


def snapshot(fact: DataFrame, dim_customer: DataFrame,
             staged_items: DataFrame) -> DataFrame:
    """One row: facts, revenue, customer versions and staged items."""
    return fact.agg(
        F.count("*").alias("fact_rows"),
        F.coalesce(F.sum("price"), F.lit(0)).cast("double").alias("revenue")).select(
        "fact_rows", "revenue",
        dim_customer.agg(F.count("*")).scalar().alias("dim_customer_rows"),
        staged_items.agg(F.count("*")).scalar().alias("staged_items"))
