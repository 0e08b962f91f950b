"""Layer tables as versioned Parquet folders behind a pointer.

``write_candidate`` writes the next state of a table, or of some of its
partitions, into a folder of its own and never touches a published one. Checks
read it through ``preview``. ``publish`` then appends one small file of pointers,
for all tables at once: it appears whole or not at all, so a run that dies at any
moment leaves the last published state, and nothing is copied. A pointer names
the folder of a table, or of one partition of a partitioned table, whose other
partitions stay as they are. A folder that a pointer names and that isn't there
is an error; only a table without any pointer is one that doesn't exist yet.

Large tables are partitioned by a period or by a hash bucket of their key
(``parts``), so a merge reads and writes the partitions of the incoming rows only.
With its pointer a partition keeps a *state*: the figures that its checks need and
that merge into those of the table (operators.quality).

What a step has worked up is told by the folders it has *seen*: ``publish`` notes
them together with the results, and ``unseen`` gives the partitions whose folder
is another one by now. A stream's batches are noted the same way.

``vacuum`` removes the folders that no pointer names any more; it must not run
beside a cycle or a reader of an older state. One cycle runs at a time.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import bound, measure, mergeable
from ..session import (append_state, child_names, compact_state, delete_path, path_exists)

# Conditions of a landing directory that is absent or holds no data file yet.
NO_DATA = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
POINTER_DDL = ("seq long, table_name string, part string, folder string, "
               "columns string, state string")
POINTERS = "meta/pointers"
PART = "_part"
SEEN = "seen/"


def bucket(key: str, buckets: int) -> str:
    return f"pmod(xxhash64({key}), {buckets})"


def default_parts(buckets: int = 16) -> dict[str, str]:
    """Partition value of each large table, as SQL over its columns. Customers lie
    with their person, so one bucket holds all addresses of a person."""
    return {"staging/orders": "purchase_period", "staging/order_items": "purchase_period",
            "staging/order_versions": bucket("order_id", buckets),
            "staging/item_versions": bucket("order_id, order_item_id", buckets),
            "staging/customers": bucket("customer_unique_id", buckets),
            "staging/customer_versions": bucket("customer_id", buckets),
            "warehouse/dim_product": bucket("product_id", buckets),
            "warehouse/dim_seller": bucket("seller_id", buckets),
            "warehouse/dim_geography": bucket("zip_code_prefix", buckets),
            "warehouse/dim_customer": bucket("customer_unique_id", buckets),
            "warehouse/fact_order_items": "purchase_period",
            "marts/revenue_daily": "purchase_period",
            "marts/delivery_performance": "purchase_period",
            "marts/last_days": "purchase_period",
            "marts/person_months": bucket("customer_unique_id", buckets),
            "marts/cohort_parts": "bucket"}


@dataclass
class Version:
    """Columns of a table, and folder and state of each partition ('' if it has none)."""
    columns: StructType
    folders: dict[str, str | None]
    states: dict[str, dict] = field(default_factory=dict)

    def only(self, parts: Iterable) -> Version:
        wanted = set(map(str, parts))
        return Version(self.columns, {p: f for p, f in self.folders.items() if p in wanted},
                       {p: s for p, s in self.states.items() if p in wanted})

    def then(self, new: Version) -> Version:
        """The table after the partitions of ``new`` have replaced these."""
        folders = {p: f for p, f in (self.folders | new.folders).items() if f is not None}
        states = {p: s for p, s in self.states.items() if p not in new.folders} | new.states
        return Version(new.columns, folders, {p: s for p, s in states.items() if p in folders})


@dataclass
class Layers:
    spark: SparkSession
    root: str
    parts: dict[str, str] = field(default_factory=default_parts)
    _candidates: dict[tuple[int, str], Version] = field(default_factory=dict)
    _published: dict[str, Version] | None = None
    _measured: dict[tuple[str, str, str], dict] = field(default_factory=dict)
    _seq: int = 0

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    # ---- landing (raw) and small state -----------------------------------

    def append_run(self, table: str, df: DataFrame) -> None:
        """Append-only landing. A replayed run replaces its own partition."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_run_id").parquet(self.path(table)))

    def landed(self, table: str) -> DataFrame | None:
        """All landed rows of a raw table, None before the first ones."""
        try:
            return self.spark.read.parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() not in NO_DATA:
                raise
            return None

    def landed_runs(self, table: str) -> list[int]:
        """Ids of the runs that landed rows: one folder each."""
        return sorted(int(n.partition("=")[2]) for n in child_names(
            self.spark, self.path(table)) if n.startswith("_run_id="))

    def landed_of(self, table: str, runs: Sequence[int], columns: StructType) -> DataFrame:
        """Landed rows of these runs only, without their run id."""
        there = [r for r in runs if path_exists(
            self.spark, f"{self.path(table)}/_run_id={r}")]
        if not there:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(
            *[f"{self.path(table)}/_run_id={r}" for r in there])

    def state(self, table: str, ddl: str) -> DataFrame:
        """Small run state; empty if nothing was recorded yet."""
        if not self.exists(table):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).json(self.path(table))

    # ---- published tables ------------------------------------------------

    def refresh(self) -> None:
        """Look at the pointers anew; what was read before keeps its folders."""
        self._published = None

    def _latest(self) -> DataFrame:
        return (self.state(POINTERS, POINTER_DDL)
                .groupBy("table_name", F.coalesce("part", F.lit("")).alias("part"))
                .agg(F.max_by(F.struct("folder", "columns", "seq", "state"), "seq").alias("v"))
                .select("table_name", "part", "v.*"))

    def _current(self) -> dict[str, Version]:
        """Tables and the folders of their partitions: bounded by calendar and buckets."""
        if self._published is None:
            self._published = {}
            for r in self._latest().orderBy("seq").collect():
                columns = StructType.fromJson(json.loads(r["columns"]))
                version = self._published.setdefault(r["table_name"], Version(columns, {}))
                version.columns = columns
                if r["folder"] is not None:
                    version.folders[r["part"]] = r["folder"]
                    if r["state"]:
                        version.states[r["part"]] = json.loads(r["state"])
                self._seq = max(self._seq, r["seq"])
        return self._published

    def _frame(self, version: Version | None) -> DataFrame | None:
        if version is None:
            return None
        folders = [f for f in version.folders.values() if f is not None]
        if not folders:
            return self.spark.createDataFrame([], version.columns)
        return self.spark.read.schema(version.columns).parquet(*folders)

    def read(self, table: str, like: DataFrame | None = None,
             parts: Iterable | None = None) -> DataFrame | None:
        """The published table, or only some of its partitions; if there is none yet,
        an empty frame of ``like``'s schema. Raw tables are read as they have landed."""
        if table.startswith("raw/"):
            found = self.landed(table)
        else:
            version = self._current().get(table)
            found = self._frame(version if version is None or parts is None
                                else version.only(parts))
        return found if found is not None or like is None else like.limit(0)

    def part_column(self, table: str) -> Column:
        return F.expr(self.parts[table]).cast("string")

    def parts_of(self, table: str, df: DataFrame) -> list[str]:
        """Partitions that the rows of ``df`` belong to: bounded by calendar or buckets."""
        return sorted(r[0] for r in df.select(self.part_column(table)).distinct().collect())

    def published_parts(self, table: str) -> dict[str, str]:
        """Partition and folder of what is published."""
        version = self._current().get(table)
        return dict(version.folders) if version else {}

    def write_candidate(self, run_id: int, table: str, df: DataFrame,
                        replaces: Iterable = (), checks: Sequence = ()) -> DataFrame:
        """Write the next state of a table, or of the partitions in ``df``. Those that
        it ``replaces`` and has no rows for go. ``checks`` are measured partition by
        partition on what was written, and kept with its pointer."""
        folder = f"{self.path(table)}/v-{uuid.uuid4().hex}"
        if table in self.parts:
            (df.withColumn(PART, self.part_column(table)).hint("rebalance", F.col(PART))
             .write.partitionBy(PART).parquet(folder))
            folders = {n.partition("=")[2]: f"{folder}/{n}"
                       for n in child_names(self.spark, folder) if n.startswith(f"{PART}=")}
            folders = dict.fromkeys(map(str, replaces)) | folders
        else:
            df.write.parquet(folder)
            folders = {"": folder}
        version = self._candidates[run_id, table] = Version(df.schema, folders)
        if not table.startswith("_work/"):
            version.states = self.measured(table, version, checks)
        return self._frame(version)

    def measured(self, table: str, version: Version, checks: Sequence) -> dict[str, dict]:
        """States of all partitions of a version, in one pass over it."""
        part = self.part_column(table) if table in self.parts else F.lit("")
        return measure(self._frame(version), part, checks)

    def note(self, run_id: int, table: str, part: str, key: str, value) -> None:
        """Keep one more figure with a candidate's partition."""
        self._candidates[run_id, table].states.setdefault(part, {})[key] = value

    def candidate(self, run_id: int, table: str) -> DataFrame | None:
        return self._frame(self._candidates.get((run_id, table)))

    def touched(self, run_id: int, table: str) -> list[str]:
        """Partitions of the candidate: bounded by calendar or buckets."""
        version = self._candidates.get((run_id, table))
        return sorted(version.folders) if version else []

    def next_version(self, run_id: int, table: str) -> Version | None:
        """The table as it would be after publishing."""
        new, old = self._candidates.get((run_id, table)), self._current().get(table)
        if new is None or old is None or table not in self.parts:
            return new or old
        return old.then(new)

    def preview(self, run_id: int, table: str, parts: Iterable | None = None
                ) -> DataFrame | None:
        version = self.next_version(run_id, table)
        return self._frame(version if version is None or parts is None else version.only(parts))

    def states(self, run_id: int, table: str, checks: Sequence = (),
               parents: Callable[[], Mapping[str, DataFrame]] = dict) -> dict[str, dict]:
        """State of each partition after publishing. Of partitions that were published
        without these figures (by ``replace``, or before a check was declared) they
        are measured now, and kept with the next publish; only then ``parents`` gives
        the frames that references are looked up in."""
        version = self.next_version(run_id, table)
        if version is None:
            return {}
        names = {c.name for c in checks if mergeable(c)} | {"rows"}
        lacking = [p for p, f in version.folders.items()
                   if f is not None and not names <= set(version.states.get(p, {}))]
        if lacking:
            found = self.measured(table, version.only(lacking), bound(checks, parents()))
            empty = {n: 0 for n in names}
            for p in lacking:
                version.states[p] = version.states.get(p, {}) | found.get(p, empty)
                self._measured[table, p, version.folders[p]] = version.states[p]
        return version.states

    def rows(self, run_id: int, table: str, parts: Iterable | None = None) -> int:
        """Rows after publishing, from the states."""
        wanted = None if parts is None else set(map(str, parts))
        return sum(s["rows"] for p, s in self.states(run_id, table).items()
                   if wanted is None or p in wanted)

    # ---- what a step has worked up ---------------------------------------

    def unseen(self, step: str, table: str, run_id: int | None = None) -> dict[str, str | None]:
        """Partitions whose folder a step has not seen yet, with the folder that it
        has (None if none). With a run id, candidates of that run count."""
        version = (self._current().get(table) if run_id is None
                   else self.next_version(run_id, table))
        seen = self.published_parts(f"{SEEN}{step}/{table}")
        now = {p: f for p, f in (version.folders if version else {}).items() if f is not None}
        return {p: seen.get(p) for p in now.keys() | seen.keys() if now.get(p) != seen.get(p)}

    def seen_frame(self, table: str, folders: Iterable[str]) -> DataFrame | None:
        """The rows a step saw in these folders."""
        version = self._current().get(table)
        return None if version is None else self._frame(
            Version(version.columns, {str(i): f for i, f in enumerate(folders)}))

    def seen_batch(self, stream: str) -> int:
        """Last batch of a stream that was published, -1 before the first one."""
        return int(self.published_parts(f"{SEEN}{stream}").get("", "-1"))

    def publish(self, run_id: int, tables: Sequence[str], whole: bool = False,
                seen: Mapping[str, Mapping[str, str | None]] | None = None) -> None:
        """Point at the candidates of ``tables``, all at once. ``whole``: partitions
        that a candidate doesn't have go. ``seen`` notes, in the same file, folders
        (or anything else) by name and partition."""
        current, rows = self._current(), []
        seq = self._seq + 1

        def row(table, part, folder, columns, state=None):
            rows.append({"seq": seq, "table_name": table, "part": part, "folder": folder,
                         "columns": columns,
                         "state": json.dumps(state) if state else None})

        for table in tables:
            version = self._candidates.get((run_id, table))
            if version is None:
                continue
            gone = {p: None for p in current[table].folders
                    } if whole and table in current else {}
            # A table without partitions' folders still has its columns.
            for p, f in (gone | version.folders or {"": None}).items():
                row(table, p, f, version.columns.json(), version.states.get(p))
        for name, parts in (seen or {}).items():
            for p, f in parts.items():
                row(f"{SEEN}{name}", p, f, StructType().json())
        written = {(r["table_name"], r["part"]) for r in rows}
        for (table, p, f), figures in self._measured.items():
            if table in current and current[table].folders.get(p) == f and (
                    table, p) not in written:
                row(table, p, f, current[table].columns.json(), figures)
        self._measured.clear()
        if rows:
            append_state(self.spark, self.path(POINTERS), rows)
            self.refresh()
        for table in tables:
            self._candidates.pop((run_id, table), None)

    def replace(self, run_id: int, table: str, df: DataFrame) -> None:
        """Publish ``df`` as the whole table."""
        self.write_candidate(run_id, table, df)
        self.publish(run_id, [table], whole=True)

    def compact(self, files: int = 50) -> None:
        """Bring the pointers into one file where they are in more than ``files``."""
        compact_state(self.spark, self.path(POINTERS), self._latest, files)

    def drop_work(self) -> None:
        """Remove what steps have written for themselves."""
        if path_exists(self.spark, self.path("_work")):
            delete_path(self.spark, self.path("_work"))
        self._candidates = {k: v for k, v in self._candidates.items()
                            if not k[1].startswith("_work/")}

    def vacuum(self) -> int:
        """Remove version folders that no pointer names; returns how many."""
        named = {f for version in self._current().values() for f in version.folders.values()}
        removed = 0
        for table in [t for t in self._current() if not t.startswith(SEEN)]:
            used = {f.split(f"{self.path(table)}/")[1].split("/")[0]
                    for f in named if f.startswith(f"{self.path(table)}/")}
            for name in child_names(self.spark, self.path(table)):
                if name.startswith("v-") and name not in used:
                    removed += delete_path(self.spark, f"{self.path(table)}/{name}")
        return removed


# ---- marks ---------------------------------------------------------------

EPOCH = dt.datetime(1970, 1, 1)


def read_mark(layers: Layers, table: str) -> dt.datetime:
    """Stored high-water mark, or the epoch."""
    value = layers.published_parts(f"{SEEN}mark/{table}").get("")
    return dt.datetime.fromisoformat(value) if value else EPOCH


def mark(table: str, value: dt.datetime | None) -> dict[str, dict[str, str | None]]:
    """A mark as ``publish`` notes it, None to forget it."""
    return {f"mark/{table}": {"": value.isoformat() if value else None}}
