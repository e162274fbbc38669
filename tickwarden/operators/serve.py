"""Reads behind a dashboard: by symbol and time range, newest first, by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the base table; an anomaly table has those of its own value.
BASE_COLUMNS = ("uuid", "symbol", "price", "volume", "trade_ts", "ingestion_ts")
PRICE_COLUMNS = tuple(c for c in BASE_COLUMNS if c != "volume")
VOLUME_COLUMNS = tuple(c for c in BASE_COLUMNS if c != "price")


def base_rows(flagged: DataFrame) -> DataFrame:
    """The base table's columns; the detectors' columns are pruned away unread."""
    return flagged.select(*BASE_COLUMNS)


def price_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("price_flag")).select(*PRICE_COLUMNS)


def volume_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("volume_flag")).select(*VOLUME_COLUMNS)


def _time(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def in_range(df: DataFrame, symbol: str, start, end, time: str = "ingestion_ts",
             closed: bool = True) -> DataFrame:
    """Rows of one symbol from `start` to `end`, with or without the bounds themselves."""
    at, lo, hi = F.col(time), _time(start), _time(end)
    inside = (at >= lo) & (at <= hi) if closed else (at > lo) & (at < hi)
    return df.filter((F.col("symbol") == symbol) & inside)


def trailing(df: DataFrame, symbol: str, as_of, width: str = "15 minutes",
             time: str = "ingestion_ts") -> DataFrame:
    """Rows of one symbol in the last `width` up to `as_of`."""
    now = _time(as_of)
    return in_range(df, symbol, now - F.expr(f"INTERVAL {width}"), now, time)


def overlay(base: DataFrame, anomalies: DataFrame, value: str, time: str = "ingestion_ts"
            ) -> DataFrame:
    """A series and its anomalies on one time axis, told apart by `kind`."""
    columns = ["symbol", value, time]
    return base.select(*columns, F.lit("series").alias("kind")).unionByName(
        anomalies.select(*columns, F.lit("anomaly").alias("kind"))
    )


def newest(df: DataFrame, symbol: str, n: int, time: str = "ingestion_ts", tie: str = "uuid"
           ) -> DataFrame:
    """The latest `n` rows of a symbol; each task keeps only its own top n."""
    return df.filter(F.col("symbol") == symbol).orderBy(F.desc(time), tie).limit(n)


def lookup(df: DataFrame, uuid: str) -> DataFrame:
    return df.filter(F.col("uuid") == uuid)


def chronological(df: DataFrame, time: str) -> DataFrame:
    """A newest-first table in time order."""
    return df.orderBy(F.asc(time))
