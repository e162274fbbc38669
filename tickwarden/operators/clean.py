"""Combining, parsing, scaling and labelling tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.operators.fill import fill_with_mean, interpolate
from tickwarden.operators.scope import Scoped
from tickwarden.operators.series import Series, plan_layout, with_position
from tickwarden.schemas import TIME_TEXT


def union_predictions(stocks: DataFrame, price_anomalies: DataFrame, volume_anomalies: DataFrame
                      ) -> DataFrame:
    """Stored rows and both anomaly tables in one table, predictions tagged with 1."""
    return stocks.unionByName(
        price_anomalies.withColumn("price_pred", F.lit(1)), allowMissingColumns=True
    ).unionByName(volume_anomalies.withColumn("volume_pred", F.lit(1)), allowMissingColumns=True)


def renumber(df: DataFrame, time: str = "ingestion_ts", ties: Sequence[str] = ("uuid",),
             name: str = "row_no") -> DataFrame:
    """Number all rows from 0 in ascending time order."""
    return with_position(df, plan_layout(df, Series((), time, tuple(ties))), name)


def combine_for_evaluation(stocks: DataFrame, price_anomalies: DataFrame,
                           volume_anomalies: DataFrame) -> DataFrame:
    """Union, order by ingestion time, interpolate price and volume, then fill with means."""
    combined = union_predictions(stocks, price_anomalies, volume_anomalies)
    numbered = renumber(combined, ties=("uuid", "price_pred", "volume_pred"))
    filled = interpolate(numbered, ("price", "volume"), Series((), "row_no", ()))
    return fill_with_mean(filled, ("price", "volume"))


def parse_time(column: str, pattern: str = TIME_TEXT) -> Column:
    """Lenient parse; text that is not a time becomes NULL."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern))


def parse_times(df: DataFrame, columns: Sequence[str], pattern: str = TIME_TEXT) -> DataFrame:
    return df.withColumns({c: parse_time(c, pattern) for c in columns})


def unparsed_rows(df: DataFrame, columns: Sequence[str], pattern: str = TIME_TEXT) -> DataFrame:
    """The rows with some text that is present but not a time, one line per bad field."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns])
    bad = F.filter(
        fields,
        lambda f: f["text"].isNotNull() & F.try_to_timestamp(f["text"], F.lit(pattern)).isNull(),
    )
    return df.withColumn("_bad", F.explode(bad)).select("*", "_bad.field", "_bad.text").drop("_bad")


def parse_audit(df: DataFrame, columns: Sequence[str], pattern: str = TIME_TEXT) -> DataFrame:
    """(field, rows, unparsed) for each time column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(F.col(c).isNotNull() & parse_time(c, pattern).isNull()).alias(f"_n_{c}")
            for c in columns
        ],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"), F.col("_rows").alias("rows"),
                F.col(f"_n_{c}").alias("unparsed"),
            )
            for c in columns
        ]
    )
    return counts.select(F.explode(lines).alias("r")).select("r.*")


def as_predictions(df: DataFrame) -> DataFrame:
    """Take the injected truth columns as the predictions to compare with."""
    return df.withColumnsRenamed({"price_anomaly": "price_pred", "volume_anomaly": "volume_pred"})


def minmax(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add `<column>_normalized` scaled to 0..1; constant columns become 0."""
    ends = [
        e for c in columns for e in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))
    ]
    joined = Scoped(df, Series(), tuple(keys)).attach(df.groupBy(*keys).agg(*ends)).df
    scaled = {}
    for c in columns:
        low, high, x = F.col(f"_lo_{c}"), F.col(f"_hi_{c}"), F.col(c)
        scaled[f"{c}_normalized"] = F.when(
            x.isNotNull(), F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0))
        )
    return joined.withColumns(scaled).drop(*[f"_{e}_{c}" for c in columns for e in ("lo", "hi")])


def hour_of_day(df: DataFrame, time: str = "trade_ts") -> DataFrame:
    return df.withColumn("hour", F.hour(time))


def daily_spread(bars: DataFrame) -> DataFrame:
    return bars.withColumns(
        {
            "diff_close_open": F.col("close") - F.col("open"),
            "diff_high_low": F.col("high") - F.col("low"),
        }
    )
