"""Between wire messages and trade rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden.schemas import ENVELOPE, TRADE_NAMES

# Wire type of each Spark type, for the Avro form of a schema.
AVRO_TYPES = {T.DoubleType: "double", T.StringType: "string", T.LongType: "long"}


def avro_schema(struct: T.StructType = ENVELOPE, name: str = "message") -> str:
    """The Avro record that corresponds to a Spark schema, as JSON text."""

    def kind(dtype: T.DataType, path: str, nullable: bool):
        if isinstance(dtype, T.StructType):
            made = {
                "type": "record", "name": path,
                "fields": [
                    {"name": f.name, "type": kind(f.dataType, f"{path}_{f.name}", f.name == "c")}
                    for f in dtype.fields
                ],
            }
        elif isinstance(dtype, T.ArrayType):
            plain = isinstance(dtype.elementType, T.StringType)
            made = {"type": "array", "items": kind(dtype.elementType, path, plain)}
        else:
            made = AVRO_TYPES[type(dtype)]
        return [made, "null"] if nullable else made

    return json.dumps(kind(struct, name, False))


def decode(df: DataFrame, payload: str = "value", form: str = "json",
           schema: T.StructType = ENVELOPE) -> DataFrame:
    """Parse message bytes or text into the message's columns.

    `avro` needs Spark's external Avro module on the class path.
    """
    if form == "avro":
        from pyspark.sql.avro.functions import from_avro

        parsed = from_avro(F.col(payload), avro_schema(schema))
    elif form == "json":
        parsed = F.from_json(F.col(payload).cast("string"), schema)
    else:
        raise ValueError("messages are json or avro")
    return df.withColumn("_message", parsed).select(
        "_message.*", *[c for c in df.columns if c != payload]
    )


def explode_trades(messages: DataFrame, outer: bool = False, place: str | None = None) -> DataFrame:
    """One row per trade with the message's type; messages without trades give none.

    `outer` keeps such messages as one row of NULLs.  `place` names a column for the trade's
    place in its message.
    """
    each = F.explode_outer if outer else F.explode
    if place is not None:
        each = F.posexplode_outer if outer else F.posexplode
        others = [c for c in messages.columns if c != "data"]
        placed = messages.select(each("data").alias(place, "_trade"), *others)
        return placed.select("_trade.*", place, *others)
    others = [c for c in messages.columns if c != "data"]
    return messages.select(each("data").alias("_trade"), *others).select("_trade.*", *others)


def content_id(position: Column | None = None) -> Column:
    """An id worked out from the trade itself, so that every table and retry agrees on it.

    Give the source position (partition and offset, or file and row) where equal trades may
    repeat.
    """
    parts = [F.col("symbol"), F.unix_micros("trade_ts"), F.col("price"), F.col("volume")]
    if position is not None:
        parts.append(position)
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def normalise(trades: DataFrame, uuid: Column | None = None, ingestion: Column | None = None
              ) -> DataFrame:
    """Table names for the wire fields, trade time from milliseconds, an id and a stamp."""
    named = trades.withColumnsRenamed(TRADE_NAMES).withColumn(
        "trade_ts", F.timestamp_millis(F.col("trade_ts"))
    )
    return named.withColumns(
        {
            "uuid": uuid if uuid is not None else content_id(),
            "ingestion_ts": ingestion if ingestion is not None else F.current_timestamp(),
        }
    )


def encode(messages: DataFrame, form: str = "json", name: str = "value") -> DataFrame:
    """Messages (data, type) as one payload column."""
    body = F.struct("data", "type")
    if form == "avro":
        from pyspark.sql.avro.functions import to_avro

        return messages.select(to_avro(body, avro_schema()).alias(name))
    if form != "json":
        raise ValueError("messages are json or avro")
    return messages.select(F.to_json(body, {"ignoreNullFields": "false"}).alias(name))
