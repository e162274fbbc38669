"""Which rows a detector's statistics are taken over.

The scope is always an explicit argument, so results never depend on how Spark happens
to partition or batch the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.operators.series import (
    Layout,
    Series,
    attach,
    count_groups,
    plan_layout,
    with_position,
)


@dataclass(frozen=True)
class Scope:
    """`kind` is whole, rows, time or columns; see the functions below."""

    kind: str
    size: int = 0
    width: str = ""
    columns: tuple[str, ...] = ()


def whole() -> Scope:
    """One scope per series."""
    return Scope("whole")


def rows(size: int) -> Scope:
    """Consecutive batches of `size` rows per series; the last may be short."""
    if size < 1:
        raise ValueError("a batch needs at least one row")
    return Scope("rows", size=size)


def time_window(width: str) -> Scope:
    """Tumbling event-time windows, so results do not depend on arrival speed."""
    return Scope("time", width=width)


def by_columns(*columns: str) -> Scope:
    """Groups named by existing columns, e.g. the micro-batch stamp `ingestion_ts`."""
    return Scope("columns", columns=columns)


@dataclass(frozen=True)
class Scoped:
    """A table with its scope columns.  `bounded` scopes hold at most `limit` rows."""

    df: DataFrame
    series: Series
    keys: tuple[str, ...]
    bounded: bool = False
    limit: int = 0
    counted: tuple[int, int, int] | None = None

    @property
    def inner(self) -> Series:
        """The series within one scope."""
        return Series(self.keys, self.series.time, self.series.ties)

    def count(self) -> "Scoped":
        """With (rows, scopes, rows of the largest) filled in; later steps that keep the rows reuse it."""
        return self if self.counted else replace(self, counted=count_groups(self.df, self.keys))

    def attach(self, summary: DataFrame) -> "Scoped":
        """Join per-scope statistics back to the rows, broadcasting them if they are few."""
        spark = self.df.sparkSession
        small = session.int_conf(spark, session.BROADCAST_ROWS, session.DEFAULT_BROADCAST_ROWS)
        known = self.count()
        return replace(known, df=attach(self.df, summary, self.keys, known.counted[1], small))

    def with_columns(self, columns: dict[str, Column]) -> "Scoped":
        return replace(self, df=self.df.withColumns(columns))


def batch_numbers(
    df: DataFrame, series: Series, size: int, layout: Layout | None = None
) -> DataFrame:
    """Add `batch_id`: place in the series divided by `size`."""
    layout = layout or plan_layout(df, series)
    placed = with_position(df, layout, "_place")
    return placed.withColumn("batch_id", F.floor(F.col("_place") / size).cast("long")).drop("_place")


def mean_batch_size(df: DataFrame, column: str = "batch_size") -> int:
    """The whole part of the mean recorded batch size (one value to the driver)."""
    mean = df.agg(F.avg(column)).first()[0]
    if mean is None:
        raise ValueError(f"{column} holds no values")
    return max(1, int(mean))


def chosen_batch_size(df: DataFrame, size: int = 0, column: str = "batch_size") -> int:
    """`size` as given, or the mean recorded batch size when it is 0."""
    return size if size > 0 else mean_batch_size(df, column)


def window_start(width: str, time: str) -> Column:
    return F.window(time, width)["start"]


def scoped(df: DataFrame, series: Series, scope: Scope) -> Scoped:
    """Add the columns a scope needs and name its grouping keys."""
    if scope.kind == "whole":
        return Scoped(df, series, series.keys)
    if scope.kind == "rows":
        numbered = batch_numbers(df, series, scope.size)
        return Scoped(numbered, series, (*series.keys, "batch_id"), True, scope.size)
    if scope.kind == "time":
        framed = df.withColumn("window_start", window_start(scope.width, series.time))
        return Scoped(framed, series, (*series.keys, "window_start"))
    keys = tuple(dict.fromkeys((*series.keys, *scope.columns)))
    return Scoped(df, series, keys)
