"""Window operators. Each runs on aggregated rows: partitions are bounded by
the calendar or by the number of groups, never by the number of facts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import pct


def growth(monthly: DataFrame, order: str, value: str) -> DataFrame:
    """Previous value and growth in percent over consecutive rows."""
    w = Window.orderBy(order)
    return (monthly.withColumn(f"prev_{value}", F.lag(value).over(w))
            .withColumn("growth_pct",
                        pct(F.col(value) - F.col(f"prev_{value}"),
                            F.col(f"prev_{value}"))))


def top_n(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "rnk") -> DataFrame:
    """Rows of rank <= n in each partition; ties share a rank, gaps follow."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)


def running_total(df: DataFrame, partition: Sequence[str], order: str, value: str,
                  name: str = "running_total") -> DataFrame:
    w = (Window.partitionBy(*partition).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(value).over(w))


def rolling_rows(df: DataFrame, partition: Sequence[str], order: str, value: str,
                 rows: int = 7) -> DataFrame:
    """Average over the last ``rows`` rows (not days) and the frame's size."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(rows - 1), 0)
    return _rolling(df, w, value, rows)


def rolling_days(df: DataFrame, partition: Sequence[str], day: str, value: str,
                 days: int = 7) -> DataFrame:
    """Average over the sales days inside the last ``days`` calendar days."""
    w = (Window.partitionBy(*partition).orderBy(F.unix_date(day))
         .rangeBetween(-(days - 1), 0))
    return _rolling(df, w, value, days)


def _rolling(df: DataFrame, w, value: str, size: int) -> DataFrame:
    total = F.sum(F.col(value).cast("decimal(20,2)")).over(w)
    count = F.count(value).over(w)
    return (df.withColumn(f"{value}_{size}d_avg",
                          F.round(total / count, 2).cast("double"))
            .withColumn("days_in_window", count))


def share_of_total(df: DataFrame, value: str, name: str = "pct_of_total") -> DataFrame:
    """Share of each row in the grand total, as a scalar subquery: the total is
    taken before any limit and no row moves to a single task."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    return df.withColumn(name, pct(F.col(value), total))


def sequence_gaps(days: DataFrame, day: str,
                  partition: Sequence[str] = ()) -> DataFrame:
    """Distinct days whose successor in the set is not the next calendar day."""
    w = Window.partitionBy(*partition).orderBy(day)
    return (days.withColumn("next_day", F.lead(day).over(w))
            .withColumn("gap_days", F.datediff("next_day", day))
            .filter(F.col("gap_days") != 1))
