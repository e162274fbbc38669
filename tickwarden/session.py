"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

CHUNK_ROWS = "spark.tickwarden.chunkRows"
BROADCAST_ROWS = "spark.tickwarden.broadcastRows"
# Where a local session without a named folder has its own; Spark's own setting is fixed once it runs.
SCRATCH = "spark.tickwarden.scratchDir"
_MADE: dict[str, list[str]] = {}

# Rows one task may hold when a series has to be read in order.
DEFAULT_CHUNK_ROWS = 1_000_000
# Rows of a series that one Python worker holds at a time, strings and copies among them.
PYTHON_ROWS = 100_000
# Rows that a task of a window over cut series should sort; more make more tasks.
SORTED_ROWS = 200_000
# Rows of a per-group statistics table that may be broadcast (a few dozen bytes each).
DEFAULT_BROADCAST_ROWS = 200_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickwarden")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Trade times are UTC; casts from timestamp_ntz follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def int_conf(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def python_rows(spark: SparkSession) -> int:
    return min(PYTHON_ROWS, int_conf(spark, CHUNK_ROWS, DEFAULT_CHUNK_ROWS))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; in local mode a new one where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="tickwarden-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set(SCRATCH, named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> int:
    """Delete paths from `scratch_path` that nothing reads any more; the number of folders that were there."""
    made, gone = _MADE.get(spark.sparkContext.applicationId, []), 0
    for path in paths:
        if path in made:
            made.remove(path)
        store, own = fs.FileSystem.from_uri(path)
        if store.get_file_info(own).type == fs.FileType.Directory:
            store.delete_dir(own)
            gone += 1
    return gone


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application has put into scratch folders; results that still read them fail afterwards."""
    return discard(spark, *_MADE.pop(spark.sparkContext.applicationId, []))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For slim tables that several later passes read; it survives lost executors.
    """
    return stored_at(df, scratch_path(df.sparkSession, label))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path from `scratch_path`, to be deleted by `discard`."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
