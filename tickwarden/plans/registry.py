"""Named queries and, where one exists, the same question as ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from tickwarden import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, table folder) under its own name."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.use_utc(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = dedent(sql).strip()
        return build

    return register
