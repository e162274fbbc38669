"""Recorded trades sent again as messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.sources.decode import encode

# Label columns a recording may carry, and its names for the wire fields.
LABELS = ("price_anomaly", "volume_anomaly")
RECORDED_NAMES = {"price": "p", "symbol": "s", "trade_ts": "t", "volume": "v"}


def trade_messages(
    recorded: DataFrame,
    names: Mapping[str, str] = RECORDED_NAMES,
    message_type: str = "trade",
    at: Column | None = None,
    drop: tuple[str, ...] = LABELS,
) -> DataFrame:
    """One single-trade message per row, labels dropped, trade time `at` (default now)."""
    wire = recorded.drop(*drop).withColumnsRenamed(dict(names))
    millis = at if at is not None else F.unix_millis(F.current_timestamp())
    trade = F.struct(
        F.lit(None).cast("array<string>").alias("c"),
        F.col("p").cast("double").alias("p"),
        F.col("s").alias("s"),
        millis.alias("t"),
        F.col("v").cast("double").alias("v"),
    )
    return wire.select(F.array(trade).alias("data"), F.lit(message_type).alias("type"))


def replay(spark, path: str, schema, target: dict, checkpoint: str, files_per_batch: int = 1,
           pause: str = "1 second", form: str = "json", once: bool = False, **message):
    """Stream recorded CSV files to a sink, so many files per batch with a pause between.

    `target` holds the sink's `format` and options, e.g. kafka servers and topic or a folder.
    Returns the running query.
    """
    recorded = (
        spark.readStream.schema(schema).option("header", True)
        .option("maxFilesPerTrigger", files_per_batch).csv(path)
    )
    payload = encode(trade_messages(recorded, **message), form)
    options = dict(target)
    writer = payload.writeStream.format(options.pop("format")).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    paced = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=pause)
    return paced.start()
