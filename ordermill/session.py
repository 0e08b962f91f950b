"""Session defaults and the shared scratch location."""
from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ordermill", cores: int | str = "*",
                  shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session; on a cluster the submitter supplies master and memory.

    The number of shuffle partitions is left to AQE coalescing unless the
    caller fixes it (tests do, a cluster job should not).
    """
    builder = (
        SparkSession.builder.appName(app).master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Compressed Parquet is several times smaller than its rows in memory;
        # without this a large table looks small enough to broadcast.
        .config("spark.sql.sources.fileCompressionFactor", "6.0")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return handle_skew(builder.getOrCreate())


# Files a task writes at the same time. A task of a rebalanced write has few partitions.
OPEN_FILES = 16


def handle_skew(spark: SparkSession) -> SparkSession:
    """Let AQE split a hot join partition even where the rows' partitioning was
    to be reused above the join; it then adds a shuffle there. Without a hot
    partition the plan stays as it was. Results never depend on it.

    Tasks also keep the files of several partitions open, so a partitioned write
    need not hold and sort its rows by partition first; beyond that many it sorts."""
    for key in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{key}", "true")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return spark


# Most of a table's files, and of a shuffle, for one task. Rows in memory are six to ten
# times as large; a task that sorts or groups so many fits into a few hundred megabytes.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


def small_tasks(spark: SparkSession) -> SparkSession:
    """Bound what one task takes, where the session allows more, so that sorts before
    and after a shuffle stay in memory: the number of tasks grows with the input, not
    their size. Results never depend on it."""
    read = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_BYTES.items():
        if read(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    Taken from ``spark.checkpoint.dir``. A machine-local folder is used only
    where that is unset and the master is local (tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = getattr(scratch_root, "_local", None) or tempfile.mkdtemp(prefix="ordermill-")
        scratch_root._local = base
    return f"{base.rstrip('/')}/ordermill/{spark.sparkContext.applicationId}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes below a path, from the file system's own summary."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a path; none if it is absent."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)
            ] if fs.exists(hadoop_path) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder with what is in it; whether it was removed."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(hadoop_path, True))


def compact_state(spark: SparkSession, path: str, merged: Callable[[], DataFrame],
                  files: int) -> None:
    """Bring the state files below ``path`` into one if there are more than ``files``.

    ``merged`` reads the state and drops what is superseded. Its rows appear as one
    more file before the old ones go; readers take a row that is there twice as one,
    so a compaction that dies at any moment changes nothing.
    """
    old = [n for n in child_names(spark, path) if n.endswith(".json") and n[0] not in "._"]
    if len(old) <= files:
        return
    work = f"{path}/_{uuid.uuid4().hex}"
    (merged().coalesce(1).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .json(work))
    conf = spark._jsc.hadoopConfiguration()
    new = next(n for n in child_names(spark, work) if n.startswith("part-"))
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{work}/{new}")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{uuid.uuid4().hex}.json")
    if not part.getFileSystem(conf).rename(part, target):
        raise OSError(f"run state could not be compacted at {target}")
    for name in [*old, work.rsplit("/", 1)[1]]:
        delete_path(spark, f"{path}/{name}")


def append_state(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Add a few rows of run state as one JSON-lines file below ``path``.

    State is small and written often, so it skips the job a DataFrame write
    would cost. A file appears whole or not at all, and none is rewritten.
    """
    conf = spark._jsc.hadoopConfiguration()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{uuid.uuid4().hex}.json")
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_{target.getName()}")
    fs = target.getFileSystem(conf)
    out = fs.create(hidden)
    lines = "".join(json.dumps(r, default=lambda v: v.isoformat()) + "\n" for r in rows)
    out.write(bytearray(lines.encode()))
    out.close()
    if not fs.rename(hidden, target):
        raise OSError(f"run state could not be recorded at {target}")
