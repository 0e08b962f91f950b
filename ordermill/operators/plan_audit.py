"""What strategy a plan uses, and how a written table is laid out."""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def operators(df: DataFrame) -> Iterator:
    """The operators of the plan that runs, after adaptive re-planning.

    Under adaptive execution this runs the query's stages, so the answer is the
    same before and after an action. A stage that is used again is named there,
    but not entered twice.
    """
    root = df._jdf.queryExecution().executedPlan()
    if root.nodeName() == "AdaptiveSparkPlan":
        root = root.finalPhysicalPlan()
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        below = node.children()
        waiting += [below.apply(i) for i in range(below.size())]
        if node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())


def plan_stats(df: DataFrame) -> dict[str, int]:
    """Sort-merge and broadcast hash joins, and shuffles by a hash, that the plan has."""
    found = Counter()
    for node in operators(df):
        name = node.nodeName()
        if name == "Exchange":
            name = node.outputPartitioning().getClass().getSimpleName()
        found[name] += 1
    return {"sort_merge": found["SortMergeJoin"], "broadcast_join": found["BroadcastHashJoin"],
            "shuffles": found["HashPartitioning"]}


def audit(plans: dict[str, DataFrame]) -> DataFrame:
    """One row per labelled plan: its strategy counts and the rows it returns."""
    out = None
    for label, df in plans.items():
        row = df.agg(F.count("*").alias("result_rows")).select(
            F.lit(label).alias("plan"),
            *[F.lit(n).cast("int").alias(k) for k, n in plan_stats(df).items()],
            "result_rows")
        out = row if out is None else out.unionByName(row)
    return out


def partition_layout(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Files, bytes and rows of each partition, read from file metadata columns
    on the executors."""
    files = df.groupBy(*partitions, F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_size").alias("size")).agg(
        F.count("*").alias("rows"))
    return files.groupBy(*partitions).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"),
        F.sum("rows").alias("rows"))
