"""Dashboard reads, sources, messages and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden import schemas, session
from tickwarden.operators import detectors, serve
from tickwarden.operators.scope import batch_numbers, rows
from tickwarden.plans.detection import _z_sql
from tickwarden.plans.fixtures import (
    BARS_SQL,
    STOCKS_SQL,
    TRADE_SERIES,
    TRADES_SQL,
    daily_bars,
    events,
    stocks,
    trades,
)
from tickwarden.plans.preparation import PREDICTED_SQL, micros
from tickwarden.plans.registry import query
from tickwarden.sources import decode, files, replay, stream, symbols
from tickwarden.schemas import TABLE_SCHEMAS
from tickwarden.streaming.job import start_job, trades_from_messages
from tickwarden.streaming.sinks import write_batch_table
from tickwarden.streaming.store import Store
from tickwarden.streaming.windowed import WindowJob

FROM, TO = "2024-01-05 00:00:00", "2024-01-12 12:00:00"
STORED = "uuid, symbol, price, volume, trade_us, ingestion_us"
_STORES: dict[tuple[str, str, str], Store] = {}
_ARRIVED: dict[tuple[str, str], str] = {}
# Days of one micro-batch of the streamed queries.
DAYS = 6


def store(spark: SparkSession, sf_dir: str, name: str = "stocks") -> Store:
    """A table as the live job leaves it, written once per application: two batches compacted, one waiting.

    The anomaly tables are those of batches of 15, with the thresholds of their reads.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORES or not _STORES[key].exists():
        base = stocks(spark, sf_dir)
        rows_of = {
            "stocks": lambda: base,
            "price_anomalies": lambda: detectors.enrich(base, "zscore", rows(15)).filter("price_flag"),
            "volume_anomalies": lambda: detectors.enrich(base, "zscore", rows(15), threshold=2).filter("volume_flag"),
        }
        schema = TABLE_SCHEMAS[name]
        table = rows_of[name]().select(*schema.names)
        made = Store(spark, session.scratch_path(spark, f"store-{name}"), schema)
        for batch_id, hours in enumerate(("< 10", "BETWEEN 10 AND 19", "> 19")):
            if batch_id == 2:
                made.compact()
            write_batch_table(table.filter(f"hour(ingestion_ts) {hours}"), made.path, batch_id, None)
        _STORES[key] = made
    return _STORES[key]


def _stored(df: DataFrame) -> DataFrame:
    return micros(df.drop("batch_size", "batch_id", "trade_date"), "trade_ts", "ingestion_ts")


@query(
    f"""WITH {STOCKS_SQL} SELECT {STORED} FROM stocks
WHERE symbol = 'click' AND ingestion_ts >= TIMESTAMP '{FROM}' AND ingestion_ts <= TIMESTAMP '{TO}'"""
)
def range_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir).in_range("click", FROM, TO))


@query(
    f"""WITH {STOCKS_SQL} SELECT {STORED} FROM stocks
WHERE symbol = 'click' AND ingestion_ts > TIMESTAMP '{FROM}' AND ingestion_ts < TIMESTAMP '{TO}'"""
)
def range_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir).in_range("click", FROM, TO, closed=False))


@query(
    f"""WITH {STOCKS_SQL} SELECT {STORED} FROM stocks
WHERE symbol = 'view' AND trade_ts >= TIMESTAMP '{TO}' - INTERVAL 15 MINUTE AND trade_ts <= TIMESTAMP '{TO}'"""
)
def trailing_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir).trailing("view", TO, time="trade_ts"))


@query(
    f"""WITH {PREDICTED_SQL}
SELECT symbol, price, ingestion_us, 'series' AS kind FROM flagged UNION ALL
SELECT symbol, price, ingestion_us, 'anomaly' FROM flagged WHERE price_flag"""
)
def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = detectors.enrich(stocks(spark, sf_dir), "zscore", rows(15))
    both = serve.overlay(flagged, serve.price_anomalies(flagged), "price")
    return micros(both, "ingestion_ts")


@query(f"WITH {PREDICTED_SQL} SELECT {STORED} FROM flagged")
def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = detectors.enrich(stocks(spark, sf_dir), "zscore", rows(15))
    return micros(serve.base_rows(flagged), "trade_ts", "ingestion_ts")


@query(
    f"""WITH {PREDICTED_SQL} SELECT uuid, symbol, price, trade_us, ingestion_us FROM flagged
WHERE price_flag AND symbol = 'click' AND ingestion_us BETWEEN epoch_us(TIMESTAMP '{FROM}') AND epoch_us(TIMESTAMP '{TO}')"""
)
def price_anomaly_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir, "price_anomalies").in_range("click", FROM, TO))


@query(
    f"""WITH {STOCKS_SQL}, batched AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // 15 AS batch_id FROM stocks),
{_z_sql('batched', 'symbol, batch_id', 2)}
SELECT uuid, symbol, volume, trade_us, ingestion_us FROM flagged
WHERE volume_flag AND symbol = 'click' AND ingestion_us BETWEEN epoch_us(TIMESTAMP '{FROM}') AND epoch_us(TIMESTAMP '{TO}')"""
)
def volume_anomaly_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir, "volume_anomalies").in_range("click", FROM, TO))


@query(
    f"""WITH {STOCKS_SQL} SELECT {STORED} FROM stocks WHERE symbol = 'purchase'
ORDER BY ingestion_ts DESC, uuid LIMIT 100"""
)
def newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(store(spark, sf_dir).newest("purchase", 100))


@query(f"WITH {TRADES_SQL} SELECT uuid, symbol, price, volume, trade_us FROM trades WHERE uuid = '777'")
def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(store(spark, sf_dir).lookup("777").select("uuid", "symbol", "price", "volume", "trade_ts"), "trade_ts")


@query(f"WITH {BARS_SQL} SELECT CAST(day AS BIGINT) AS day, open, high, low, close FROM bars ORDER BY day")
def chronological_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.chronological(daily_bars(spark, sf_dir).drop("total"), "day")


@query(
    f"""WITH {PREDICTED_SQL} SELECT {STORED}, CAST(3 AS DOUBLE) AS threshold, CAST(15 AS INTEGER) AS window_size
FROM flagged WHERE price_flag"""
)
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = detectors.enrich(stocks(spark, sf_dir), "zscore", rows(15)).filter("price_flag")
    return micros(detectors.legacy_rows(flagged, 3.0, 15), "trade_ts", "ingestion_ts")


@query(
    f"""WITH {TRADES_SQL} SELECT uuid, symbol, price, volume, trade_us FROM trades
WHERE symbol IN ('click', 'view', 'purchase', 'unknown')"""
)
def symbol_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(symbols.valid(trades(spark, sf_dir), _listed(spark)), "trade_ts")


@query(
    f"""WITH {TRADES_SQL} SELECT uuid, symbol, price, volume, trade_us FROM trades
WHERE symbol NOT IN ('click', 'view', 'purchase', 'unknown')"""
)
def symbol_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(symbols.rejected(trades(spark, sf_dir), _listed(spark)), "trade_ts")


def _listed(spark: SparkSession) -> DataFrame:
    names = [("click",), ("view",), ("purchase",), ("unknown",)]
    return spark.createDataFrame(names, "symbol string")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as messages of up to 15 trades of one symbol."""
    batched = batch_numbers(trades(spark, sf_dir), TRADE_SERIES, 15)
    trade = F.struct(
        F.lit(None).cast("array<string>").alias("c"), F.col("price").alias("p"),
        F.col("symbol").alias("s"), F.unix_millis("trade_ts").alias("t"),
        F.col("volume").alias("v"),
    )
    keyed = F.struct(F.col("trade_ts"), F.col("uuid"), trade.alias("trade"))
    grouped = batched.groupBy("symbol", "batch_id").agg(
        F.sort_array(F.collect_list(keyed)).alias("_rows")
    )
    return grouped.select(
        F.transform("_rows", lambda r: r["trade"]).alias("data"), F.lit("trade").alias("type")
    )


MESSAGES_SQL = (
    TRADES_SQL
    + """,
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // 15 AS batch_id FROM trades),
messages AS (
  SELECT to_json({'data': list({'c': NULL, 'p': price, 's': symbol, 't': trade_us // 1000, 'v': volume}
    ORDER BY trade_ts, uuid), 'type': 'trade'}) AS value
  FROM batched GROUP BY symbol, batch_id)"""
)


@query(
    f"""WITH {MESSAGES_SQL},
opened AS (
  SELECT value->>'$.type' AS type, unnest(from_json(value->'$.data', '[{{"p":"DOUBLE","s":"VARCHAR","t":"BIGINT","v":"DOUBLE"}}]')) AS x
  FROM messages)
SELECT x.p AS price, x.s AS symbol, CAST(x.t * 1000 AS BIGINT) AS trade_us, x.v AS volume, type FROM opened"""
)
def envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode messages, decode them again, one row per trade, table names and types."""
    payload = decode.encode(envelopes(spark, sf_dir))
    flat = decode.normalise(decode.explode_trades(decode.decode(payload)))
    return micros(flat, "trade_ts").select("price", "symbol", "trade_us", "volume", "type")


@query(
    f"""WITH {TRADES_SQL}
SELECT symbol, CAST(count(*) AS BIGINT) AS trades, CAST(2 * count(*) AS BIGINT) AS ids FROM trades GROUP BY 1"""
)
def message_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message sent twice: each trade of each has an id of its own."""
    sent = decode.encode(envelopes(spark, sf_dir)).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("partition"), "value")
    numbered = sent.select("value", "partition", F.lit("trades").alias("topic"), F.xxhash64("value").alias("offset"))
    found = trades_from_messages(numbered).groupBy("symbol", "uuid").agg(F.count(F.lit(1)).alias("n"))
    return found.groupBy("symbol").agg((F.sum("n") / 2).cast("long").alias("trades"), F.count(F.lit(1)).alias("ids"))


@query(
    f"""WITH {TRADES_SQL}
SELECT CAST(to_json({{'data': [{{'c': NULL, 'p': price, 's': symbol, 't': 1735689600000, 'v': volume}}], 'type': 'trade'}}) AS VARCHAR) AS value
FROM trades"""
)
def replay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    recorded = trades(spark, sf_dir).select("symbol", "trade_ts", "price", "volume")
    return decode.encode(
        replay.trade_messages(recorded, at=F.lit(1735689600000).cast("long"))
    )


@query(
    f"""WITH {TRADES_SQL}
SELECT uuid, symbol, price, volume FROM trades ORDER BY trade_ts, uuid LIMIT 4000"""
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 4000 trades in time order, as the evaluation takes them."""
    chosen = files.first_rows(trades(spark, sf_dir), 4000, ["trade_ts", "uuid"])
    return chosen.select("uuid", "symbol", "price", "volume")


@query(f"WITH {TRADES_SQL} SELECT symbol, trade_us, price, 'trade' AS type, volume FROM trades")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export with header, read back with a schema and parse the times."""
    path = session.scratch_path(spark, "export")
    out = trades(spark, sf_dir).select(
        "symbol", F.date_format("trade_ts", schemas.TIME_TEXT).alias("trade_ts"), "price",
        F.lit(None).cast("string").alias("trade_conditions"), F.lit("trade").alias("type"), "volume",
    )
    files.write_csv(out, path)
    back = files.read_csv(
        spark, path, schemas.RECORDED_CSV, ["symbol", "trade_ts", "price", "type", "volume"]
    )
    parsed = F.try_to_timestamp("trade_ts", F.lit(schemas.TIME_TEXT))
    return micros(back.withColumn("trade_ts", parsed), "trade_ts")


def trade_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of trades."""
    from tickwarden.plans.fixtures import as_trades

    schema = events(spark, sf_dir).schema
    return as_trades(stream.file_stream(spark, sf_dir, schema, pathGlobFilter="events.parquet"))


def daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of trades from a file per day, some days at a time, oldest first.

    The files are written once per application; those of DAYS days are one job, so that the order of their
    arrival follows the days.
    """
    from tickwarden.plans.fixtures import as_trades

    source = events(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ARRIVED or not Store(spark, _ARRIVED[key], source.schema).exists():
        path = session.scratch_path(spark, "days")
        dated = source.withColumn("day", F.to_date("ts"))
        days = [r["day"] for r in dated.select("day").distinct().sort("day").collect()]  # as many as days
        for at in range(0, len(days), DAYS):
            some = dated.filter(F.col("day").isin(days[at : at + DAYS])).repartition("day")
            some.write.mode("append").partitionBy("day").parquet(path)
        _ARRIVED[key] = path
    return as_trades(stream.file_stream(spark, _ARRIVED[key], source.schema, files_per_batch=DAYS))


@query(
    f"""WITH {TRADES_SQL}, windowed AS (
  SELECT *, trade_us // 21600000000 AS window_no FROM trades),
{_z_sql('windowed', 'symbol, window_no')}
SELECT uuid, symbol, price, volume, trade_us, price_flag, volume_flag FROM flagged"""
)
def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of every event-time window from a stream of several batches, the last windows closed by the end of input."""
    path = session.scratch_path(spark, "windows")
    windows = WindowJob(f"{path}/out", width="6 hours", late="1 hour")
    windows.start(daily_stream(spark, sf_dir), f"{path}/state", {"availableNow": True}).awaitTermination()
    windows.finish(spark)
    return micros(windows.flagged(spark).drop("window_end"), "trade_ts")


@query(
    f"""WITH {TRADES_SQL}, stamped AS (
  SELECT *, (dense_rank() OVER (ORDER BY trade_us // 86400000000) - 1) // {DAYS} AS batch FROM trades),
{_z_sql('stamped', 'batch', 1.6)},
parts AS (
  SELECT 'stocks' AS "table", batch, count(*) AS n FROM flagged GROUP BY batch
  UNION ALL SELECT 'price_anomalies', batch, count(*) FROM flagged WHERE price_flag GROUP BY batch
  UNION ALL SELECT 'volume_anomalies', batch, count(*) FROM flagged WHERE volume_flag GROUP BY batch)
SELECT "table", CAST(sum(n) AS BIGINT) AS n, CAST(max(n) AS BIGINT) AS batch_size, CAST(count(*) AS BIGINT) AS batches
FROM parts GROUP BY 1"""
)
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live job over several micro-batches: rows of its three tables after compaction."""
    path = session.scratch_path(spark, "job")
    arriving = daily_stream(spark, sf_dir).withColumn("ingestion_ts", F.current_timestamp())
    start_job(
        arriving, f"{path}/tables", f"{path}/state", "zscore", trigger={"availableNow": True},
        threshold=1.6,
    ).awaitTermination()
    parts = []
    for name, schema in TABLE_SCHEMAS.items():
        table = Store(spark, f"{path}/tables/{name}", schema)
        table.compact()
        batches = table.live().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
        counts = batches.agg(F.sum("n").alias("n"), F.max("n").alias("batch_size"), F.count(F.lit(1)).alias("batches"))
        parts.append(counts.withColumn("table", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
