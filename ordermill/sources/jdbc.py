"""Relational source over JDBC."""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to divide a table into parallel reads. The bounds shape the ranges,
    they do not filter: rows outside fall into the first or last one."""
    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(url: str, table: str, user: str, password: str, driver: str,
                 split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password,
               "driver": driver, "fetchsize": str(fetch_size)}
    if split is not None:
        if split.partitions < 1:
            raise ValueError("partitions must be positive")
        options |= {"partitionColumn": split.column, "lowerBound": str(split.lower),
                    "upperBound": str(split.upper),
                    "numPartitions": str(split.partitions)}
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Without a split the whole table comes through one task: give one for
    anything but small dimensions."""
    return spark.read.format("jdbc").options(**options).load()
