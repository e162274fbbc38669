"""Reading and writing recorded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: Sequence[str] | None = None, first: int | None = None,
             order: Sequence[str] = ()) -> DataFrame:
    """A CSV table with header and known types, some columns, and if asked the first rows.

    Files have no row order in Spark, so `first` needs the columns that define it.
    """
    table = spark.read.schema(schema).option("header", True).csv(path)
    return first_rows(table.select(*columns) if columns else table, first, order)


def first_rows(table: DataFrame, first: int | None, order: Sequence[str]) -> DataFrame:
    if first is None:
        return table
    if not order:
        raise ValueError("the first rows of what order?")
    return table.orderBy(*order).limit(first)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)
