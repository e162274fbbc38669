"""What the operators of this folder share."""

from __future__ import annotations

import contextlib
import functools
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden import session

# Rows of a batch handed to Python; with texts of 100,000 characters still tens of megabytes.
BATCH_ROWS = 500


def ready(spark: SparkSession) -> None:
    """Settings of a session that runs these operators."""
    session.use_utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the folder in spark.checkpoint.dir and read back: short lineage, safe from lost executors."""
    return session.stored(df, f"llm-{label}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def links_in_tile(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links for one tile: at most one per row and column, with the same components.

    `linked[i, j]` says whether left[i] and right[j] are linked; an id may occur on both sides.
    """
    rows, cols = linked.any(1), linked.any(0)
    linked, left, right = linked[rows][:, cols], left[rows], right[cols]
    if not len(left):
        return left, right
    none = np.iinfo(np.int64).max
    ids, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    at_left, at_right = place[: len(left)], place[len(left) :]
    label = np.arange(len(ids))
    while True:
        before = label.copy()
        low = np.where(linked, label[at_left][:, None], none).min(0)
        np.minimum.at(label, at_right, low)
        low = np.where(linked, label[at_right][None, :], none).min(1)
        np.minimum.at(label, at_left, low)
        if (label == before).all():
            break
    keep = label != np.arange(len(ids))
    return ids[keep], ids[label[keep]]


@contextlib.contextmanager
def exchanges_deleted(spark: SparkSession, **conf: str):
    """In here files of an exchange go as soon as its query has ended, not when the driver happens to collect its garbage."""
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | conf
    before = {name: spark.conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def placed_by(df: DataFrame, key: str) -> DataFrame:
    """A checkpoint that lies partitioned by `key`, so that later groupings by it move nothing.

    Adaptive plans don't tell their partitioning, so the plan written here is a fixed one.
    """
    spark = df.sparkSession
    session.checkpoint_dir(spark)
    with exchanges_deleted(spark, **{"spark.sql.adaptive.enabled": "false"}):
        return df.repartition(partitions(spark), key).checkpoint()


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def unused(columns, name: str) -> str:
    """`name`, with underscores until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a number for each row, and that column's name; a stored table numbers its rows alike each time."""
    name = unused(docs.columns, "_row")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equal in all columns; NULLs are equal too."""
    met = [left[n].eqNullSafe(right[n]) for n in names]
    return functools.reduce(lambda a, b: a & b, met)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A stored table with a broadcast hint if it has at most `rows` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df
