"""Parquet sinks, pruned scans and format comparisons."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_bytes


def write_partitioned(df: DataFrame, path: str,
                      partitions: Sequence[str] = ("year", "month"),
                      dynamic: bool = False) -> None:
    """Overwrite ``path``, one directory per partition value.

    The rebalance gathers each partition into one file where it is small and
    lets AQE split it where it is not, so a partition holding much of the data
    does not end in a single task. ``dynamic`` replaces only the partitions
    present in ``df``.
    """
    (df.hint("rebalance", *[F.col(p) for p in partitions])
       .write.mode("overwrite").partitionBy(*partitions)
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .parquet(path))


def read_pruned(spark: SparkSession, path: str, condition: str | Column,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Scan only the partitions and columns asked for."""
    df = spark.read.parquet(path).filter(condition)
    return df.select(*columns) if columns else df


def compare_codecs(df: DataFrame, root: str,
                   codecs: Sequence[str] = ("snappy", "gzip", "none")) -> DataFrame:
    """Size of the same rows as CSV and as Parquet per codec.

    Columns: format, rows read back, bytes, times smaller than CSV.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("header", "true").csv(f"{root}/csv")
    csv_bytes = path_bytes(spark, f"{root}/csv")
    back = spark.read.schema(df.schema).option("header", "true").csv(f"{root}/csv")
    out = _format_row(back, "csv", csv_bytes, csv_bytes)
    for codec in codecs:
        path = f"{root}/parquet_{codec}"
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        out = out.unionByName(_format_row(
            spark.read.parquet(path), f"parquet ({codec})", path_bytes(spark, path),
            csv_bytes))
    return out


def _format_row(df: DataFrame, name: str, size: int, csv_size: int) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("format"), "rows", F.lit(size).cast("long").alias("bytes"),
        F.lit(round(csv_size / size, 2)).alias("times_smaller"))


def type_roundtrip(df: DataFrame, root: str) -> DataFrame:
    """Which columns keep their type through inferred CSV and through Parquet.

    ``filled`` counts the non-NULL values read back from Parquet.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("header", "true").csv(f"{root}/types_csv")
    df.write.mode("overwrite").parquet(f"{root}/types_parquet")
    csv = spark.read.options(header="true", inferSchema="true").csv(f"{root}/types_csv")
    parquet = spark.read.parquet(f"{root}/types_parquet")
    csv_types, parquet_types = dict(csv.dtypes), dict(parquet.dtypes)
    filled = parquet.agg(*[F.count(c).alias(c) for c in df.columns])
    return filled.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("original"),
                 F.lit(csv_types[c]).alias("csv"), F.lit(parquet_types[c]).alias("parquet"),
                 F.lit(t == csv_types[c]).alias("csv_ok"),
                 F.lit(t == parquet_types[c]).alias("parquet_ok"),
                 F.col(c).alias("filled"))
        for c, t in df.dtypes])))


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Materialise a query and return the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def insert_select(df: DataFrame, path: str) -> DataFrame:
    """Append a query's rows to a stored table; columns match by name."""
    spark = df.sparkSession
    df.select(*spark.read.parquet(path).columns).write.mode("append").parquet(path)
    return spark.read.parquet(path)
