"""Reading the tables and writing intermediate ones where all executors see them."""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import handle_skew, path_bytes, scratch_root


#: Rows of a batch handed to Python, where whole texts are: an executor holds a batch of
#: each task three times and more, in its own buffers, and read and held by Python.
BATCH_ROWS = 1_000


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a session that was started elsewhere find this package.

    A cluster has it installed or gets it with --py-files; the path is then unused.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), root) if x)
    return handle_skew(spark)


def lean(spark: SparkSession) -> SparkSession:
    """The session with small batches; no result depends on how rows are batched."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def unused(columns: Iterable[str], name: str) -> str:
    """``name`` with as many underscores before it as it takes to be none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below spark.checkpoint.dir; the table read back, and its path.

    Cuts the lineage: what reads it survives lost executors without repeating
    what made it, and sees one fixed set of rows.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``stored``, by hashes of ``key``: a join on it needs no shuffle of this side.

    There are as many buckets as a shuffle has partitions, or the join would deal anew."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.bucketBy(n, key)
     .option("path", f"{scratch_root(spark)}/llm/{name}").saveAsTable(name, format="parquet"))
    return spark.table(name)


def size_checked(df: DataFrame, path: str, limit: int = 4 << 20) -> DataFrame:
    """``df``, read from ``path``, with a broadcast hint only if its files are small.

    Files are compressed up to some tenfold; the limit leaves room for that.
    """
    return df.hint("broadcast") if path_bytes(df.sparkSession, path) <= limit else df
