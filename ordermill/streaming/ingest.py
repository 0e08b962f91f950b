"""Continuous arrival of the same data: file streams into raw and staging."""
from __future__ import annotations

import hashlib
import json
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, staging
from ..operators.merge import upsert_update
from ..plans.staging_merge import ORPHANS, STAGING, StagingMerge
from ..session import child_names
from ..sources.binding import Source
from ..sources.layers import Layers

#: Name of each stream: its raw table, key, staging table, table of versions.
STREAMS = {
    "customers": ("raw/customers", ["customer_id"], "staging/customer_versions"),
    "orders": ("raw/orders", ["order_id"], "staging/order_versions"),
    "order_items": ("raw/order_items", ["order_id", "order_item_id"],
                    "staging/item_versions"),
}
VERSION = "_extracted_at"


class StreamSource(Source):
    """The same entities over streams of the test tables' files."""

    def __init__(self, spark: SparkSession, sf_dir: str, files_per_batch: int = 100):
        super().__init__(spark, sf_dir)
        self.files_per_batch = files_per_batch

    def table(self, name: str) -> DataFrame:
        # A table is a folder of files, or one file, which a file stream can only
        # find in the folder around it: by its whole name, not by how it begins.
        file = f"{name}.parquet"
        path = f"{self.sf_dir}/{file}"
        stream = self.spark.readStream.schema(self.spark.read.parquet(path).schema).option(
            "maxFilesPerTrigger", self.files_per_batch)
        if child_names(self.spark, path) == [file]:
            return stream.option("pathGlobFilter", file).parquet(self.sf_dir)
        return stream.parquet(path)


def ingest_available(stream: DataFrame, landing: str, checkpoint: str) -> None:
    """Land everything that has arrived, then stop.

    Each micro-batch writes its own ``_run_id`` partition and replaces it if
    the batch is replayed after a failure; the checkpoint keeps finished
    batches from running again. No keyed state is held: the staging merge picks
    the latest version of a key.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_run_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_run_id").parquet(landing))

    (stream.writeStream.foreachBatch(land)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity that a stream keeps over restarts, from its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def batch_run_id(stream: str, batch_id: int) -> int:
    """Run id of a stream's batch: negative, as those of cycles are not, and the same
    one when the batch is replayed."""
    digest = hashlib.md5(f"{stream}/{batch_id}".encode()).digest()
    return -1 - (int.from_bytes(digest[:8], "big") >> 1)


@dataclass
class StagingStream:
    """Streams of raw rows merged into the staging tables that the cycle reads.

    A micro-batch is landed, cleaned and merged like the rows of a run. Of a key the
    row with the latest ``_extracted_at`` stays, whatever order rows arrive in: the
    versions of the keys lie beside the tables, partition by partition. Items that
    come before their order wait in a partition of their own and move with it; the
    cycle's gate lets nothing through until none waits.

    The pointers of a batch and its number go into one file. A batch that is run
    again after a crash is either not published, and merged as if for the first
    time, or published, and skipped. Batches of several streams in one driver take
    turns.
    """
    layers: Layers
    months: int = 1
    checks: list[quality.Check] = field(default_factory=quality.staging_checks)
    _turn: threading.Lock = field(default_factory=threading.Lock)

    def run_available(self, name: str, stream: DataFrame, checkpoint: str) -> None:
        """Merge everything that has arrived on a stream, then stop."""
        self.start(name, stream, checkpoint, availableNow=True).awaitTermination()

    def start(self, name: str, stream: DataFrame, checkpoint: str, **trigger):
        def merge(batch: DataFrame, batch_id: int) -> None:
            with self._turn:
                self.merge_batch(name, batch, stream_id(batch.sparkSession, checkpoint),
                                 batch_id)

        return (stream.writeStream.foreachBatch(merge)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())

    def merge_batch(self, name: str, batch: DataFrame, stream: str, batch_id: int) -> None:
        layers = self.layers
        ledger = f"stream/{name}/{stream}"
        if batch_id <= layers.seen_batch(ledger):
            return
        run = batch_run_id(f"{name}/{stream}", batch_id)
        raw, keys, versions = STREAMS[name]
        if VERSION not in batch.columns:
            # Batches come one after another, so their number tells what is later.
            batch = batch.withColumn(VERSION, F.timestamp_add(
                "SECOND", F.lit(batch_id), F.lit("1970-01-01").cast("timestamp_ntz")))
        layers.append_run(raw, batch.withColumn("_run_id", F.lit(run).cast("long")))
        landed = layers.landed_of(raw, [run], batch.schema)
        step = StagingMerge(layers, run, self.checks, self.months)
        rows = self._latest(step, name, landed, keys, versions)
        if name == "customers":
            step.customers(rows)
        elif name == "orders":
            step.orders(rows)
            waiting = layers.read("staging/order_items", parts=[ORPHANS])
            if waiting is not None and not waiting.isEmpty():
                self._place(step, waiting.drop("purchase_period").limit(0))
        else:
            self._place(step, rows)
        layers.publish(run, [*STAGING, versions], seen={
            ledger: {"": str(batch_id)}, "staging/raw": {str(run): "staged"}})
        layers.drop_work()
        layers.compact()

    def _place(self, step: StagingMerge, rows: DataFrame) -> None:
        """Items into the periods of their orders, by what is staged of these."""
        orders = self.layers.preview(step.run_id, "staging/orders")
        if orders is None:
            orders = self.layers.spark.createDataFrame(
                [], "order_id long, purchase_period int").select(
                F.col("order_id").cast(rows.schema["order_id"].dataType), "purchase_period")
        step.items(rows, orders)

    def _latest(self, step: StagingMerge, name: str, landed: DataFrame, keys: list[str],
                table: str) -> DataFrame:
        """The cleaned rows of a batch that are later than what is staged; notes their
        versions. Ties go to the arriving row."""
        layers = self.layers
        clean = {"customers": staging.stage_customers, "orders": staging.stage_orders,
                 "order_items": staging.stage_items}[name]
        rows, _ = clean(landed, "version")
        if name == "orders":
            rows = step.with_period(rows)
        rows = layers.write_candidate(step.run_id, f"_work/{name}_versions", rows)
        noted = rows.select(*keys, "version")
        known = layers.read(table, noted, layers.parts_of(table, noted))
        late = known.select(*keys, F.col("version").alias("_staged"))
        fresh = layers.write_candidate(step.run_id, f"_work/{name}", rows.join(
            late, keys, "left").filter(F.coalesce(F.col("version") >= F.col("_staged"),
                                                  F.lit(True))).drop("_staged"))
        layers.write_candidate(step.run_id, table, upsert_update(
            known, noted.join(fresh.select(*keys), keys, "left_semi"), keys, ["version"]))
        return fresh.drop("version")
