"""Checking symbols against a reference list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden import session


def _matched(trades: DataFrame, symbols: DataFrame, how: str) -> DataFrame:
    known = symbols.select(F.col("symbol").alias("_known")).distinct()
    spark = trades.sparkSession
    limit = session.int_conf(spark, session.BROADCAST_ROWS, session.DEFAULT_BROADCAST_ROWS)
    fits = known.limit(limit + 1).count() <= limit
    return trades.join(
        F.broadcast(known) if fits else known, F.col("symbol") == F.col("_known"), how
    )


def valid(trades: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose symbol is listed, compared exactly."""
    return _matched(trades, symbols, "left_semi")


def rejected(trades: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose symbol is not listed."""
    return _matched(trades, symbols, "left_anti")
