"""SQL text in, frame out."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def q(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a statement over the given frames, named by their keys."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
