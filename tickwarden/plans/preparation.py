"""Windowing, gap filling, cleaning and labelling queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.operators import clean, detectors, fill, inject, resample, serve
from tickwarden.operators.scope import rows, time_window
from tickwarden.operators.series import Series
from tickwarden.plans.detection import _z_sql
from tickwarden.plans.fixtures import (
    BARS_SQL,
    HOURLY_SQL,
    STOCKS_SQL,
    TRADES_SQL,
    daily_bars,
    stocks,
    trades,
)
from tickwarden.plans.registry import query
from tickwarden.schemas import DAILY_CSV
from tickwarden.sources import files

HOUR = 3600
# Fixed value: how the daily file writes dates.
DAILY_TEXT = "MM/dd/yyyy"


def micros(df: DataFrame, *columns: str) -> DataFrame:
    """Times as microseconds since the epoch, so both engines print them alike."""
    return df.withColumns({c: F.unix_micros(c) for c in columns}).withColumnsRenamed(
        {c: c.replace("_ts", "_us") for c in columns}
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    f"""WITH {HOURLY_SQL}
SELECT symbol, hour AS bucket, round(price, 6) AS price, round(coalesce(volume, 0), 6) AS volume,
       CAST(hour * 3600000000 AS BIGINT) AS start_us FROM gappy"""
)
def resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = resample.resample(trades(spark, sf_dir), HOUR)
    return rounded(hourly.withColumn("start_us", F.unix_micros("bucket_start")).drop("bucket_start"),
                   6, "price", "volume")


@query(
    f"""WITH {TRADES_SQL}, seconds AS (
  SELECT trade_us // 1000000 AS bucket, avg(price) AS price, sum(volume) AS volume FROM trades GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(bucket), max(bucket))) AS bucket FROM seconds)
SELECT CAST(count(*) AS BIGINT) AS seconds, CAST(count(price) AS BIGINT) AS busy_seconds,
       round(sum(coalesce(volume, 0)), 4) AS volume FROM spine LEFT JOIN seconds USING (bucket)"""
)
def resample_seconds_all_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-second calendar over all trades mixed, summed up."""
    seconds = resample.resample(trades(spark, sf_dir), 1, Series(keys=()))
    return seconds.agg(
        F.count(F.lit(1)).alias("seconds"),
        F.count("price").alias("busy_seconds"),
        F.round(F.sum("volume"), 4).alias("volume"),
    )


@query(
    f"""WITH {TRADES_SQL}
SELECT uuid, symbol, round(CASE WHEN count(volume) OVER w = 3 THEN avg(volume) OVER w END, 6) AS volume_smooth
FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY trade_ts, uuid ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
)
def rolling_mean3(spark: SparkSession, sf_dir: str) -> DataFrame:
    smooth = resample.rolling_mean(trades(spark, sf_dir), ("volume",), 3)
    return rounded(smooth.select("uuid", "symbol", "volume_smooth"), 6, "volume_smooth")


@query(
    f"""WITH {TRADES_SQL}, back AS (
  SELECT *, lag(volume) OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) AS b FROM trades)
SELECT uuid, b AS volume_shift, volume - b AS volume_diff,
       round(volume / nullif(b, 0) - 1, 6) AS volume_pct_change FROM back"""
)
def diff_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = resample.changes(trades(spark, sf_dir), ("volume",))
    return rounded(
        changed.select("uuid", "volume_shift", "volume_diff", "volume_pct_change"),
        6, "volume_pct_change",
    )


@query(
    f"""WITH {TRADES_SQL}, windowed AS (
  SELECT *, trade_us // 3600000000 AS hour FROM trades),
{_z_sql('windowed', 'hour')}
SELECT CAST(hour * 3600000000 AS BIGINT) AS window_us, CAST(count(*) AS BIGINT) AS trades,
       CAST(count(*) FILTER (price_flag) AS BIGINT) AS price_hits,
       CAST(count(*) FILTER (volume_flag) AS BIGINT) AS volume_hits FROM flagged GROUP BY hour"""
)
def hourly_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling event-time windows over all symbols mixed, with the hits in each."""
    flagged = detectors.enrich(
        trades(spark, sf_dir), "zscore", time_window("1 hour"), Series(keys=())
    )
    return flagged.groupBy(F.unix_micros("window_start").alias("window_us")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.count_if("price_flag").alias("price_hits"),
        F.count_if("volume_flag").alias("volume_hits"),
    )


INTERPOLATED_SQL = (
    HOURLY_SQL
    + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY hour) AS spot FROM gappy),
near AS (
  SELECT *,
    max(CASE WHEN price IS NOT NULL THEN spot END) OVER (PARTITION BY symbol ORDER BY spot) AS a0,
    min(CASE WHEN price IS NOT NULL THEN spot END) OVER (PARTITION BY symbol ORDER BY spot
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a1
  FROM placed),
valued AS (
  SELECT n.*, p.price AS x0, q.price AS x1 FROM near n
  LEFT JOIN placed p ON p.symbol = n.symbol AND p.spot = n.a0
  LEFT JOIN placed q ON q.symbol = n.symbol AND q.spot = n.a1),
filled AS (
  SELECT symbol, hour, CASE WHEN price IS NOT NULL THEN price WHEN a1 IS NULL THEN x0
    ELSE x0 + (x1 - x0) * ((spot - a0) / CAST(a1 - a0 AS DOUBLE)) END AS price FROM valued)"""
)


@query(f"WITH {INTERPOLATED_SQL} SELECT symbol, hour AS bucket, round(price, 6) AS price FROM filled")
def interpolate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = resample.resample(trades(spark, sf_dir), HOUR)
    filled = fill.interpolate(hourly, ("price",), Series(("symbol",), "bucket", ()))
    return rounded(filled.select("symbol", "bucket", "price"), 6, "price")


@query(
    f"""WITH {HOURLY_SQL}
SELECT symbol, hour AS bucket, round(coalesce(price, (SELECT avg(price) FROM gappy)), 6) AS mean_filled,
       round(coalesce(price, 0), 6) AS zero_filled FROM gappy"""
)
def fill_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = resample.resample(trades(spark, sf_dir), HOUR).select("symbol", "bucket", "price")
    both = fill.fill_with_zero(
        hourly.withColumn("zero_filled", F.col("price")), ("zero_filled",)
    ).withColumnRenamed("price", "mean_filled")
    return rounded(fill.fill_with_mean(both, ("mean_filled",)), 6, "mean_filled", "zero_filled")


PREDICTED_SQL = (
    STOCKS_SQL
    + f""",
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // 15 AS batch_id
  FROM stocks),
{_z_sql('batched', 'symbol, batch_id')},
unioned AS (
  SELECT uuid, price, volume, symbol, trade_us, ingestion_us, batch_size, NULL AS price_pred, NULL AS volume_pred FROM flagged
  UNION ALL
  SELECT uuid, price, NULL, symbol, trade_us, ingestion_us, batch_size, 1, NULL FROM flagged WHERE price_flag
  UNION ALL
  SELECT uuid, NULL, volume, symbol, trade_us, ingestion_us, batch_size, NULL, 1 FROM flagged WHERE volume_flag)"""
)


def stored_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """stocks, price_anomalies and volume_anomalies, by z-score within batches of 15."""
    flagged = detectors.enrich(stocks(spark, sf_dir), "zscore", rows(15))
    base = ["uuid", "symbol", "trade_ts", "ingestion_ts", "batch_size"]
    return (
        flagged.select(*base, "price", "volume"),
        flagged.filter("price_flag").select(*base, "price"),
        flagged.filter("volume_flag").select(*base, "volume"),
    )


@query(
    f"""WITH {PREDICTED_SQL}
SELECT uuid, price, volume, symbol, trade_us, ingestion_us, CAST(batch_size AS BIGINT) AS batch_size,
       CAST(price_pred AS INTEGER) AS price_pred, CAST(volume_pred AS INTEGER) AS volume_pred FROM unioned"""
)
def union_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(clean.union_predictions(*stored_tables(spark, sf_dir)), "trade_ts", "ingestion_ts")


@query(
    f"""WITH {PREDICTED_SQL},
placed AS (
  SELECT *, row_number() OVER (ORDER BY ingestion_us, uuid, price_pred NULLS FIRST, volume_pred NULLS FIRST) AS spot FROM unioned),
near AS (
  SELECT *,
    max(CASE WHEN price IS NOT NULL THEN spot END) OVER (ORDER BY spot) AS p0,
    min(CASE WHEN price IS NOT NULL THEN spot END) OVER (ORDER BY spot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
    max(CASE WHEN volume IS NOT NULL THEN spot END) OVER (ORDER BY spot) AS v0,
    min(CASE WHEN volume IS NOT NULL THEN spot END) OVER (ORDER BY spot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM placed),
filled AS (
  SELECT n.spot - 1 AS row_no, n.uuid,
    CASE WHEN n.price IS NOT NULL THEN n.price WHEN p1 IS NULL THEN a.price
      ELSE a.price + (b.price - a.price) * ((n.spot - p0) / CAST(p1 - p0 AS DOUBLE)) END AS price,
    CASE WHEN n.volume IS NOT NULL THEN n.volume WHEN v1 IS NULL THEN c.volume
      ELSE c.volume + (d.volume - c.volume) * ((n.spot - v0) / CAST(v1 - v0 AS DOUBLE)) END AS volume
  FROM near n LEFT JOIN placed a ON a.spot = p0 LEFT JOIN placed b ON b.spot = p1
    LEFT JOIN placed c ON c.spot = v0 LEFT JOIN placed d ON d.spot = v1)
SELECT CAST(row_no AS BIGINT) AS row_no, uuid,
  round(coalesce(price, (SELECT avg(price) FROM filled)), 6) AS price,
  round(coalesce(volume, (SELECT avg(volume) FROM filled)), 6) AS volume FROM filled"""
)
def combined_for_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    combined = clean.combine_for_evaluation(*stored_tables(spark, sf_dir))
    return rounded(combined.select("row_no", "uuid", "price", "volume"), 6, "price", "volume")


TEXT_SQL = (
    STOCKS_SQL
    + """,
recorded AS (
  SELECT *, CASE WHEN symbol = 'error' THEN 'bad' ELSE strftime(trade_ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' END AS trade_text,
         strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS ingestion_text
  FROM stocks)"""
)


def recorded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with times as exported text; the `error` trades have unreadable ones."""
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS'+0000'"
    written = F.date_format("trade_ts", pattern)
    return stocks(spark, sf_dir).select(
        "uuid",
        "symbol",
        F.when(F.col("symbol") == "error", F.lit("bad")).otherwise(written).alias("trade_text"),
        F.date_format("ingestion_ts", pattern).alias("ingestion_text"),
    )


@query(
    f"""WITH {TEXT_SQL}
SELECT uuid, CASE WHEN trade_text <> 'bad' THEN trade_us END AS trade_us, ingestion_us FROM recorded"""
)
def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = clean.parse_times(recorded_text(spark, sf_dir), ["trade_text", "ingestion_text"])
    return parsed.select(
        "uuid",
        F.unix_micros("trade_text").alias("trade_us"),
        F.unix_micros("ingestion_text").alias("ingestion_us"),
    )


@query(
    f"""WITH {TEXT_SQL}
SELECT 'trade_text' AS field, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (trade_text = 'bad') AS BIGINT) AS unparsed FROM recorded
UNION ALL SELECT 'ingestion_text', CAST(count(*) AS BIGINT), 0 FROM recorded"""
)
def parse_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_audit(recorded_text(spark, sf_dir), ["trade_text", "ingestion_text"])


@query(
    f"WITH {TEXT_SQL} SELECT uuid, 'trade_text' AS field, trade_text AS text FROM recorded WHERE trade_text = 'bad'"
)
def unparsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = clean.unparsed_rows(recorded_text(spark, sf_dir), ["trade_text", "ingestion_text"])
    return bad.select("uuid", "field", "text")


def portable_draws(purpose: str) -> Column:
    """Draws that both engines can work out from the id: different residues per purpose."""
    factor = {
        "price_sign": 104729, "price_size": 1299709, "volume_sign": 32452843, "volume_size": 49979687,
    }[purpose]
    return (F.pmod(F.col("uuid").cast("long") * factor + 17, F.lit(1009)) + 0.5) / 1009.0


def portable_picks(column: str, k: Column, n: Column) -> Column:
    """Places of draws, some of them named twice."""
    return F.pmod(k * k * {"price": 7919, "volume": 15485863}[column] + 17, n)


def _draw_sql(factor: int) -> str:
    return f"(((CAST(uuid AS BIGINT) * {factor} + 17) % 1009) + 0.5) / 1009.0::DOUBLE"


INJECTED_SQL = (
    TRADES_SQL
    + f""",
drawn AS (
  SELECT *, {_draw_sql(104729)} AS ps, {_draw_sql(1299709)} AS pz, {_draw_sql(32452843)} AS vs, {_draw_sql(49979687)} AS vz,
         row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1 AS spot
  FROM trades),
sizes AS (SELECT symbol, count(*) AS n FROM trades GROUP BY 1 HAVING count(*) >= 3),
draws AS (SELECT symbol, n, unnest(range(greatest(1, CAST(floor(0.05::DOUBLE * n) AS BIGINT)))) AS k FROM sizes),
picked AS (
  SELECT DISTINCT symbol, 'price' AS kind, greatest(1, least((k * k * 7919 + 17) % n, n - 2)) AS spot FROM draws
  UNION SELECT DISTINCT symbol, 'volume', greatest(1, least((k * k * 15485863 + 17) % n, n - 2)) FROM draws),
near AS (
  SELECT d.*, lag(price) OVER w AS p0, lead(price) OVER w AS p1, lag(volume) OVER w AS v0, lead(volume) OVER w AS v1,
    p.spot IS NOT NULL AS phit, v.spot IS NOT NULL AS vhit
  FROM drawn d LEFT JOIN picked p ON p.symbol = d.symbol AND p.spot = d.spot AND p.kind = 'price'
  LEFT JOIN picked v ON v.symbol = d.symbol AND v.spot = d.spot AND v.kind = 'volume'
  WINDOW w AS (PARTITION BY d.symbol ORDER BY trade_ts, uuid)),
planted AS (
  SELECT *,
    round((p0 + p1) / 2 + (CASE WHEN ps < 0.5 THEN -1.0 ELSE 1.0 END)::DOUBLE * (pz * (0.00001 * 4.5)::DOUBLE) * ((p0 + p1) / 2), 2) AS pnew,
    round((v0 + v1) / 2 + (CASE WHEN vs < 0.5 THEN -1.0 ELSE 1.0 END)::DOUBLE * (vz * (0.1 * 3)::DOUBLE) * ((v0 + v1) / 2), 5) AS vnew
  FROM near),
labelled AS (
  SELECT uuid, symbol, trade_ts, CASE WHEN phit THEN pnew ELSE price END AS price, CAST(phit AS DOUBLE) AS price_anomaly,
         CASE WHEN vhit AND vnew > 0.2 THEN vnew ELSE volume END AS volume FROM planted)"""
)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject.add_anomalies(trades(spark, sf_dir), 0.05, draws=portable_draws, picks=portable_picks)


@query(f"WITH {INJECTED_SQL} SELECT uuid, price, price_anomaly FROM labelled")
def inject_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("uuid", "price", "price_anomaly")


@query(
    f"""WITH {INJECTED_SQL}
SELECT uuid, round(volume, 5) AS volume, CAST(volume > 0.2 AS DOUBLE) AS volume_anomaly FROM labelled"""
)
def inject_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        labelled(spark, sf_dir).select("uuid", "volume", "volume_anomaly"), 5, "volume"
    )


@query(
    f"""WITH {INJECTED_SQL}
SELECT uuid, price_anomaly AS price_pred, CAST(volume > 0.2 AS DOUBLE) AS volume_pred FROM labelled"""
)
def truth_as_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.as_predictions(labelled(spark, sf_dir)).select("uuid", "price_pred", "volume_pred")


@query(
    f"""WITH {TRADES_SQL}
SELECT uuid, round(coalesce((volume - min(volume) OVER ()) / nullif(max(volume) OVER () - min(volume) OVER (), 0), 0), 6) AS volume_normalized
FROM trades"""
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = clean.minmax(trades(spark, sf_dir), ["volume"])
    return rounded(scaled.select("uuid", "volume_normalized"), 6, "volume_normalized")


@query(
    f"""WITH {TRADES_SQL}
SELECT CAST(hour(trade_ts) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS trades, round(avg(price), 6) AS price
FROM trades GROUP BY 1"""
)
def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_hour = clean.hour_of_day(trades(spark, sf_dir)).groupBy("hour")
    return by_hour.agg(F.count(F.lit(1)).alias("trades"), F.round(F.avg("price"), 6).alias("price"))


@query(
    f"""WITH {BARS_SQL}
SELECT CAST(day AS BIGINT) AS day, open, high, low, close, round(close - open, 4) AS diff_close_open,
       round(high - low, 4) AS diff_high_low FROM bars"""
)
def ohlc_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = clean.daily_spread(daily_bars(spark, sf_dir)).drop("total")
    return rounded(bars, 4, "diff_close_open", "diff_high_low")


@query(
    f"""WITH {BARS_SQL}
SELECT CAST(day AS BIGINT) AS day, round(close - open, 4) AS diff_close_open, round(high - low, 4) AS diff_high_low FROM bars"""
)
def daily_file_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of daily bars, newest first as data vendors send it, read, turned round and spread."""
    path = session.scratch_path(spark, "daily")
    bars = daily_bars(spark, sf_dir).withColumn("Date", F.date_format(F.date_from_unix_date(F.col("day").cast("int")), DAILY_TEXT))
    named = bars.withColumnsRenamed({"close": "Close/Last", "open": "Open", "high": "High", "low": "Low"})
    files.write_csv(named.orderBy(F.desc("day")).select(*DAILY_CSV.names), path)
    read = files.read_csv(spark, path, DAILY_CSV, ["Close/Last", "Open", "High", "Low", "Date"])
    dated = read.withColumn("day", F.unix_date(F.to_date("Date", DAILY_TEXT)).cast("long"))
    plain = dated.withColumnsRenamed({"Close/Last": "close", "Open": "open", "High": "high", "Low": "low"})
    spread = clean.daily_spread(serve.chronological(plain, "day"))
    return rounded(spread, 4, "diff_close_open", "diff_high_low").select("day", "diff_close_open", "diff_high_low")
