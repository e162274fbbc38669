"""Event-time windows on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_zscore(
    trades: DataFrame,
    columns: Sequence[str] = ("price", "volume"),
    width: str = "1 hour",
    late: str = "10 minutes",
    threshold: float = 3.0,
    time: str = "trade_ts",
    keys: Sequence[str] = ("symbol",),
    spread: int | None = None,
) -> DataFrame:
    """Z-score flags within tumbling event-time windows, emitted when a window closes.

    Window statistics are a streaming aggregate, joined back to the window's rows.  Rows of a
    hot key are dealt over `spread` join partitions (all of them by default) and the few
    statistics rows repeated, so no window is ever collected.  NULL keys form a key of their own.  Rows later than `late` are dropped by the watermark.
    """
    spread = spread or int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = trades.withWatermark(time, late)
    framed = F.window(time, width)
    stats = (
        marked.groupBy(*[F.col(k).alias(f"_on_{k}") for k in keys], framed.alias("_framed"))
        .agg(
            *[F.avg(c).alias(f"_mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"_std_{c}") for c in columns],
        )
        .withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    # a stream may carry one event-time column, so the trade time itself travels as a number
    rows = (
        marked.withColumns({"window": framed, "_us": F.unix_micros(time)})
        .drop(time)
        .withColumn("_part", F.pmod(F.xxhash64("_us", *columns), F.lit(spread)).cast("int"))
    )
    same = (F.col("window") == F.col("_framed")) & (F.col("_part") == F.col("_deal"))
    for k in keys:
        # structs, as NULLs inside are equal
        same = same & (F.struct(F.col(k).alias("k")) == F.struct(F.col(f"_on_{k}").alias("k")))
    joined = rows.join(stats, same, "inner")
    flags = {
        f"{c}_flag": F.coalesce(
            F.abs(F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))) > threshold,
            F.lit(False),
        )
        for c in columns
    }
    others = [c for c in trades.columns if c != time]
    return joined.withColumns(flags).select(
        *others,
        F.timestamp_micros("_us").alias(time),
        F.col("window")["start"].alias("window_start"),
        *flags,
    )
