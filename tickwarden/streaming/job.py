"""The live job: one stream, one pass per micro-batch, three tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwarden.operators import serve
from tickwarden.operators.detectors import detect
from tickwarden.operators.scope import Scope, by_columns
from tickwarden.operators.series import Series
from tickwarden.sources.decode import content_id, decode, explode_trades, normalise
from tickwarden.streaming.sinks import write_batch_table

# Table names.
TABLES = {"base": "stocks", "price": "price_anomalies", "volume": "volume_anomalies"}


def trades_from_messages(stream: DataFrame, form: str = "json", payload: str = "value",
                         position: Sequence[str] | None = None) -> DataFrame:
    """Typed trades with an id each: equal trades differ by message and place in the message.

    `position` names the columns that tell messages apart, by default those of topic, partition and
    offset that are there; a stream of files has them from `stream.file_positions`.  An empty `position` says that
    equal messages may share their ids.
    """
    if position is None:
        position = [c for c in ("topic", "partition", "offset") if c in stream.columns]
        if not position:
            raise ValueError("nothing tells equal messages apart: name the columns that do")
    at = F.concat_ws(",", *[F.col(c).cast("string") for c in position])
    messages = decode(stream.select(F.col(payload), at.alias("_position")), payload, form)
    flat = explode_trades(messages, place="_place")
    named = normalise(flat, content_id(F.concat_ws(",", "_position", "_place")))
    return named.drop("_position", "_place")


def process_batch(batch: DataFrame, batch_id: int, method: str, root: str,
                  scope: Scope, series: Series, tables: Mapping[str, str], params: Mapping) -> None:
    """Flag a micro-batch once and write the base rows and both kinds of anomalies.

    Each table's part is written under its batch number and replaced on a retry, so a batch
    that runs twice leaves one copy.
    """
    held = batch.persist()
    flagged = None
    try:
        flagged = detect(held, method, ("price", "volume"), scope, series, **params).persist()
        counts = flagged.agg(
            F.count(F.lit(1)).alias("base"),
            F.count_if("price_flag").alias("price"),
            F.count_if("volume_flag").alias("volume"),
        ).first()
        parts = {
            "base": serve.base_rows(flagged),
            "price": serve.price_anomalies(flagged),
            "volume": serve.volume_anomalies(flagged),
        }
        for kind, part in parts.items():
            if counts[kind] > 0:
                write_batch_table(part, f"{root}/{tables[kind]}", batch_id, counts[kind])
    finally:
        if flagged is not None:
            flagged.unpersist()
        held.unpersist()


def start_job(
    trades: DataFrame,
    root: str,
    checkpoint: str,
    method: str = "arima",
    scope: Scope = by_columns("ingestion_ts"),
    series: Series = Series(keys=()),
    trigger: Mapping | None = None,
    tables: Mapping[str, str] = TABLES,
    **params,
) -> StreamingQuery:
    """Start the job on a stream of normalised trades.

    `trigger` is what `writeStream.trigger` takes, e.g. {"processingTime": "5 seconds"} or
    {"availableNow": True}; without one a batch starts when the last has ended.
    """
    run = partial(
        process_batch, method=method, root=root, scope=scope, series=series, tables=tables,
        params=params,
    )
    writer = trades.writeStream.foreachBatch(run).outputMode("update").option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_configurations(trades: DataFrame, root: str, checkpoint: str,
                         windows: Mapping[str, list[int]], thresholds: Mapping[str, float],
                         methods: Mapping[str, str], trigger: Mapping | None = None
                         ) -> StreamingQuery:
    """All window sizes of all value columns in one query, written with their settings."""
    from tickwarden.operators.detectors import run_configurations

    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for column, sizes in windows.items():
                found = run_configurations(
                    held, sizes, thresholds[column], column, methods[column]
                )
                write_batch_table(found, f"{root}/{column}_configurations", batch_id, None)
        finally:
            held.unpersist()

    writer = trades.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def wait(spark: SparkSession) -> None:
    """Block until any of the running queries ends."""
    spark.streams.awaitAnyTermination()
