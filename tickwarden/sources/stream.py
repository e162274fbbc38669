"""Streams of messages or trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(servers: str, topic: str, min_partitions: int | None = None,
                  max_offsets: int | None = None, starting: str = "latest",
                  **more: str) -> dict[str, str]:
    """Options of a topic scan; `max_offsets` bounds the rows of one micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options | more


def kafka_stream(spark: SparkSession, **settings) -> DataFrame:
    """A topic as a stream; needs Spark's external Kafka module on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(**settings)).load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet",
                files_per_batch: int | None = None, **options: str) -> DataFrame:
    """Files arriving in a folder as a stream, `files_per_batch` at a time."""
    reader = spark.readStream.schema(schema).format(form).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def file_positions(messages: DataFrame) -> DataFrame:
    """Add topic and partition to messages read from files, tables or streams: the file, and where its part begins.

    Parquet files also tell the row, as offset.  Of other forms equal messages in one part of a file stay alike.  A
    batch that is read again has the same files and parts, so its messages keep their positions.
    """
    where = F.col("_metadata")
    columns = [where["file_path"].alias("topic"), where["file_block_start"].alias("partition")]
    if "row_index" in messages.select("_metadata").schema["_metadata"].dataType.names:
        columns.append(where["row_index"].alias("offset"))
    return messages.select("*", *columns)
