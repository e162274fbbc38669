"""Writing micro-batches and keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden.operators.scope import Scoped
from tickwarden.operators.series import Series, sort_key


def stamp_batch_size(df: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Add `batch_size`: how many rows share the batch columns."""
    sizes = df.groupBy(*batch).agg(F.count(F.lit(1)).alias("batch_size"))
    return Scoped(df, Series(), tuple(batch)).attach(sizes).df


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("symbol", "ingestion_ts"),
    newest: str = "trade_ts",
    tie: str = "uuid",
) -> DataFrame:
    """One row per key, as a keyed store would keep: the newest, then the lowest `tie`.

    An aggregate rather than a ranking, so a hot key is reduced before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    age = F.coalesce(-sort_key(df, newest), F.lit(float("inf")))
    row = F.struct(*[F.col(c) for c in others])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(row, F.struct(age, F.col(tie))).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def write_batch_table(df: DataFrame, path: str, batch_id: int, batch_size: int | None) -> None:
    """Write one micro-batch's part of a table, replacing what an earlier try left.

    Files are cut by trade day and ordered by symbol and newest trade, so symbol and time
    filters skip most of them; Bloom filters do the same for ids.
    """
    stamped = df if batch_size is None else df.withColumn("batch_size", F.lit(batch_size).cast("long"))
    dated = stamped.withColumn("trade_date", F.to_date("trade_ts"))
    (
        dated.sortWithinPartitions("trade_date", "symbol", F.desc("trade_ts"))
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#uuid", "true")
        .partitionBy("trade_date")
        .parquet(f"{path}/batch_id={batch_id}")
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by micro-batches; empty if no batch has had rows for it yet.

    Besides `schema` there are the folder columns `batch_id` and `trade_date`, which filters
    on batch and day can use to skip files.
    """
    folders = [T.StructField("batch_id", T.LongType()), T.StructField("trade_date", T.DateType())]
    full = T.StructType([*schema.fields, *folders])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
