"""The given tables seen as trades, stored stocks, messages and daily bars.

Each view exists twice: as a DataFrame and as the SQL of a common table expression, so
a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden.operators.series import Series

TRADE_SERIES = Series(("symbol",), "trade_ts", ("uuid",))

TRADES_SQL = """trades AS (
  SELECT CAST(event_id AS VARCHAR) AS uuid, event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, ts AS trade_ts,
         epoch_us(ts) AS trade_us
  FROM events)"""

STOCKS_SQL = (
    TRADES_SQL
    + """,
stocks AS (
  SELECT *, date_trunc('hour', trade_ts) + INTERVAL 1 HOUR AS ingestion_ts,
         epoch_us(date_trunc('hour', trade_ts) + INTERVAL 1 HOUR) AS ingestion_us,
         count(*) OVER (PARTITION BY date_trunc('hour', trade_ts)) AS batch_size
  FROM trades)"""
)

BARS_SQL = """bars AS (
  SELECT epoch_us(date_trunc('day', l_shipdate)) // 86400000000 AS day,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS open,
         arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS close,
         round(sum(l_extendedprice), 2) AS total
  FROM lineitem GROUP BY 1)"""

HOURLY_SQL = (
    TRADES_SQL
    + """,
hours AS (SELECT symbol, trade_us // 3600000000 AS hour, avg(price) AS price, sum(volume) AS volume
          FROM trades GROUP BY 1, 2),
spine AS (SELECT symbol, unnest(generate_series(min(hour), max(hour))) AS hour FROM hours GROUP BY 1),
gappy AS (SELECT s.symbol, s.hour, h.price, h.volume FROM spine s LEFT JOIN hours h USING (symbol, hour))"""
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_trades(events_table: DataFrame) -> DataFrame:
    return events_table.select(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("trade_ts"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(events(spark, sf_dir))


def with_ingestion(df: DataFrame) -> DataFrame:
    """Stamp each trade with the hour's end, standing for the micro-batch that stored it."""
    return df.withColumn(
        "ingestion_ts", F.date_trunc("hour", "trade_ts") + F.expr("INTERVAL 1 HOUR")
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored base table: trades, their batch stamp, and the rows in that batch."""
    from tickwarden.streaming.sinks import stamp_batch_size

    return stamp_batch_size(with_ingestion(trades(spark, sf_dir)), ["ingestion_ts"])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.unix_date(F.col("l_shipdate").cast("date")).cast("long").alias("day"),
        "l_extendedprice",
        F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
        ).alias("at"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open, high, low, close and total of line prices per ship day (day number)."""
    price = F.col("l_extendedprice")
    return (
        lines(spark, sf_dir)
        .groupBy("day")
        .agg(
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.min_by(price, "at").alias("open"),
            F.max_by(price, "at").alias("close"),
            F.round(F.sum(price), 2).alias("total"),
        )
    )


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        lines(spark, sf_dir).groupBy("day")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))  # cents; sums vary in the last bit
        .withColumn("name", F.lit("total"))
    )


DAILY_SERIES = Series(("name",), "day", ())
