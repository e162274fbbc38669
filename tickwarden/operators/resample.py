"""Calendar buckets, rolling means and row-to-row changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwarden.operators.series import Layout, Series, plan_layout, sliding

MICROS = 1_000_000
# Buckets one row of the spine expands to at a time, so no task builds a long array.
SPINE_BLOCK = 4096


def bucket_number(time: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(time) / F.lit(seconds * MICROS)).cast("long")


def bucket_spine(buckets: DataFrame, keys: tuple[str, ...], name: str = "bucket") -> DataFrame:
    """Every bucket number between a series' first and last, built in parallel blocks."""
    ends = buckets.groupBy(*keys).agg(F.min(name).alias("_lo"), F.max(name).alias("_hi"))
    starts = F.sequence(F.col("_lo"), F.col("_hi"), F.lit(SPINE_BLOCK).cast("long"))
    spread = ends.withColumn("_from", F.explode(starts)).repartition(*keys, "_from")
    stop = F.least(F.col("_from") + SPINE_BLOCK - 1, F.col("_hi"))
    return spread.select(*keys, F.explode(F.sequence(F.col("_from"), stop)).alias(name))


def resample(
    df: DataFrame,
    seconds: int,
    series: Series = Series(),
    means: tuple[str, ...] = ("price",),
    sums: tuple[str, ...] = ("volume",),
) -> DataFrame:
    """One row per calendar bucket and series, empty buckets included.

    Means of empty buckets are NULL and sums are 0.  `bucket` counts buckets from the epoch
    and `bucket_start` is its time.
    """
    keys = series.keys
    filled = (
        df.withColumn("bucket", bucket_number(series.time, seconds))
        .groupBy(*keys, "bucket")
        .agg(*[F.avg(c).alias(c) for c in means], *[F.sum(c).alias(c) for c in sums])
    )
    spine = bucket_spine(filled, keys)
    renamed = filled.withColumnsRenamed({k: f"_{k}" for k in (*keys, "bucket")})
    same = spine["bucket"] == F.col("_bucket")
    for k in keys:
        same = same & spine[k].eqNullSafe(F.col(f"_{k}"))
    joined = spine.join(renamed, same, "left").drop(*[f"_{k}" for k in (*keys, "bucket")])
    return joined.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0.0)) for c in sums},
            "bucket_start": F.timestamp_micros(F.col("bucket") * F.lit(seconds * MICROS)),
        }
    )


def rolling_mean(
    df: DataFrame, columns: tuple[str, ...], size: int, series: Series = Series(),
    layout: Layout | None = None,
) -> DataFrame:
    """Add `<column>_smooth`: the mean of the last `size` rows, NULL until there are as many."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(1 - size, 0)
        return d.withColumns(
            {
                f"{c}_smooth": F.when(F.count(c).over(frame) == size, F.avg(c).over(frame))
                for c in columns
            }
        )

    return sliding(df, layout or plan_layout(df, series), size - 1, 0, add)


def changes(
    df: DataFrame, columns: tuple[str, ...], series: Series = Series(), periods: int = 1,
    layout: Layout | None = None,
) -> DataFrame:
    """Add `<column>_shift`, `_diff` and `_pct_change` against the row `periods` back.

    A change from zero is NULL.
    """

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        made = {}
        for c in columns:
            back = F.lag(c, periods).over(w)
            made[f"{c}_shift"] = back
            made[f"{c}_diff"] = F.col(c) - back
            made[f"{c}_pct_change"] = F.try_divide(F.col(c), back) - 1.0
        return d.withColumns(made)

    return sliding(df, layout or plan_layout(df, series), periods, 0, add)
