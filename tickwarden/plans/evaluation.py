"""Detector evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden.operators import detectors, evaluate
from tickwarden.operators.scope import by_columns, rows, whole
from tickwarden.operators.series import Series
from tickwarden.plans.detection import _arima_sql, _iqr_sql, _mad_sql, _z_sql
from tickwarden.plans.fixtures import STOCKS_SQL, stocks
from tickwarden.plans.preparation import INJECTED_SQL, labelled, rounded
from tickwarden.plans.registry import query

RATIOS = ("accuracy", "precision", "recall", "f1")

# Planted price anomalies as truth, interquartile flags of the changed prices as prediction.
JUDGED_SQL = (
    INJECTED_SQL
    + f""",
{_iqr_sql('labelled', 'symbol')},
judged AS (SELECT symbol, price_anomaly = 1 AS t, price_flag AS p FROM flagged)"""
)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.detect(labelled(spark, sf_dir), "iqr", ("price", "volume"), whole())


def _counts_sql(t: str = "t", p: str = "p") -> str:
    return f"""CAST(count(*) FILTER (NOT {t} AND NOT {p}) AS BIGINT) AS tn, CAST(count(*) FILTER (NOT {t} AND {p}) AS BIGINT) AS fp,
  CAST(count(*) FILTER ({t} AND NOT {p}) AS BIGINT) AS fn, CAST(count(*) FILTER ({t} AND {p}) AS BIGINT) AS tp"""


RATIOS_SQL = """round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""


@query(f"WITH {JUDGED_SQL} SELECT symbol, {_counts_sql()} FROM judged GROUP BY 1")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(judged(spark, sf_dir), "price_anomaly", "price_flag", ["symbol"])


@query(f"WITH {JUDGED_SQL} SELECT {_counts_sql('p', 't')} FROM judged")
def confusion_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(judged(spark, sf_dir), "price_anomaly", "price_flag", swap=True)


@query(
    f"""WITH {JUDGED_SQL}, matrix AS (SELECT {_counts_sql()}, CAST(count(*) AS DOUBLE) AS total FROM judged),
cells AS (
  SELECT 'True Neg' AS cell, tn AS n, total FROM matrix UNION ALL SELECT 'False Pos', fp, total FROM matrix
  UNION ALL SELECT 'False Neg', fn, total FROM matrix UNION ALL SELECT 'True Pos', tp, total FROM matrix)
SELECT cell, n, round(100 * n / total, 2) AS share_pct,
       format('{{}} {{}} {{:.2f}}%', cell, n, round(100 * n / total, 2)) AS label FROM cells"""
)
def confusion_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = evaluate.confusion(judged(spark, sf_dir), "price_anomaly", "price_flag")
    return evaluate.labelled_cells(matrix)


@query(
    f"""WITH {JUDGED_SQL}, matrix AS (SELECT symbol, {_counts_sql()} FROM judged GROUP BY 1)
SELECT symbol, {RATIOS_SQL} FROM matrix"""
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = evaluate.confusion(judged(spark, sf_dir), "price_anomaly", "price_flag", ["symbol"])
    return rounded(evaluate.metrics(matrix, ["symbol"]), 6, *RATIOS)


@query(
    f"""WITH {STOCKS_SQL}, {_z_sql('stocks', 'ingestion_us').replace('flagged', 'online')},
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // 15 AS batch_id FROM stocks),
{_z_sql('batched', 'symbol, batch_id')},
pairs AS (
  SELECT 'price' AS "column", o.price_flag AS t, f.price_flag AS p FROM flagged f JOIN online o USING (uuid)
  UNION ALL SELECT 'volume', o.volume_flag, f.volume_flag FROM flagged f JOIN online o USING (uuid)),
matrix AS (SELECT "column", {_counts_sql()} FROM pairs GROUP BY 1)
SELECT "column", tn, fp, fn, tp, {RATIOS_SQL} FROM matrix"""
)
def online_offline_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags stored per micro-batch against the same detector over batches of 15 rows."""
    stored = detectors.enrich(
        stocks(spark, sf_dir), "zscore", by_columns("ingestion_ts"), Series(keys=())
    )
    predictions = stored.select(
        "uuid",
        F.col("price_flag").cast("int").alias("price_pred"),
        F.col("volume_flag").cast("int").alias("volume_pred"),
    )
    base = evaluate.join_predictions(
        stocks(spark, sf_dir), predictions.filter("price_pred + volume_pred > 0"),
        ["price_pred", "volume_pred"],
    )
    return rounded(evaluate.agreement(base, "zscore", rows(15)), 6, *RATIOS)


@query(
    f"""WITH {STOCKS_SQL}, {_z_sql('stocks', 'ingestion_us')}
SELECT uuid, CAST(price_flag AS INTEGER) AS price_pred, CAST(volume_flag AS INTEGER) AS volume_pred FROM flagged"""
)
def predictions_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly tables brought back to their base rows by id."""
    stored = detectors.enrich(
        stocks(spark, sf_dir), "zscore", by_columns("ingestion_ts"), Series(keys=())
    )
    joined = stocks(spark, sf_dir)
    for c in ("price", "volume"):
        hits = stored.filter(f"{c}_flag").select("uuid", F.lit(1).alias(f"{c}_pred"))
        joined = evaluate.join_predictions(joined, hits, [f"{c}_pred"])
    return joined.select("uuid", "price_pred", "volume_pred")


def _method_sql(name: str, flags: str) -> str:
    renamed = flags
    for part in ("bounds", "centred", "spread", "flagged"):
        renamed = renamed.replace(part, f"{name}_{part}")
    return renamed


METHODS = ("zscore", "iqr", "mad")


@query(
    f"""WITH {INJECTED_SQL}, {_method_sql('zscore', _z_sql('labelled', 'symbol'))},
{_method_sql('iqr', _iqr_sql('labelled', 'symbol'))},
{_method_sql('mad', _mad_sql('symbol', 'labelled', 3.0))},
pairs AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS method, 'price' AS "column", price_anomaly = 1 AS t, price_flag AS p FROM {m}_flagged
  UNION ALL SELECT '{m}', 'volume', volume > 0.2, volume_flag FROM {m}_flagged"""
        for m in METHODS
    )
    + f"""),
matrix AS (SELECT method, "column", {_counts_sql()} FROM pairs GROUP BY 1, 2)
SELECT method, "column", tn, fp, fn, tp, {RATIOS_SQL} FROM matrix"""
)
def method_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = {"price": "price_anomaly", "volume": "volume_anomaly"}
    table = evaluate.compare_methods(
        labelled(spark, sf_dir), {m: {"method": m} for m in METHODS}, truth
    )
    return rounded(table, 6, *RATIOS)


@query(
    f"""WITH RECURSIVE {INJECTED_SQL}, {_arima_sql('labelled', 'symbol')},
pairs AS (
  SELECT 'price' AS "column", l.price_anomaly = 1 AS t, f.price_flag AS p FROM labelled l JOIN flagged f ON f.uuid = l.uuid
  UNION ALL SELECT 'volume', l.volume > 0.2, f.volume_flag FROM labelled l JOIN flagged f ON f.uuid = l.uuid),
matrix AS (SELECT 'arima' AS method, "column", {_counts_sql()} FROM pairs GROUP BY 1, 2)
SELECT method, "column", tn, fp, fn, tp, {RATIOS_SQL} FROM matrix"""
)
def method_comparison_arima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted residual detector on the labelled rows."""
    truth = {"price": "price_anomaly", "volume": "volume_anomaly"}
    return rounded(evaluate.compare_methods(labelled(spark, sf_dir), {"arima": {}}, truth), 6, *RATIOS)


@query()
def method_comparison_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two fitted detectors on the same labelled rows."""
    truth = {"price": "price_anomaly", "volume": "volume_anomaly"}
    runs = {m: {"method": m} for m in ("arima", "iforest")}
    return rounded(evaluate.compare_methods(labelled(spark, sf_dir), runs, truth), 6, *RATIOS)


@query(
    f"""WITH {STOCKS_SQL}
SELECT uuid, symbol, trade_us, ingestion_us, price, volume, CAST(batch_size AS BIGINT) AS batch_size FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, ingestion_ts ORDER BY trade_ts DESC, uuid) AS k FROM stocks) AS r
WHERE k = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickwarden.plans.preparation import micros
    from tickwarden.streaming.sinks import latest_per_key as latest

    return micros(latest(stocks(spark, sf_dir)), "trade_ts", "ingestion_ts")


@query(
    f"""WITH {STOCKS_SQL} SELECT ingestion_us, CAST(max(batch_size) AS BIGINT) AS batch_size,
  CAST(count(*) AS BIGINT) AS n FROM stocks GROUP BY 1"""
)
def stamp_batch_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stocks(spark, sf_dir).groupBy(F.unix_micros("ingestion_ts").alias("ingestion_us")).agg(
        F.max("batch_size").alias("batch_size"), F.count(F.lit(1)).alias("n")
    )
