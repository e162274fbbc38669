"""Descriptive statistics, histograms and normality tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden.functions.normal import normal_quantile, normal_upper, polynomial
from tickwarden.operators.quantiles import quantiles
from tickwarden.operators.series import Series, plan_layout, with_position, with_totals


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max."""
    parts = []
    for c in columns:
        parts += [
            F.count(c).alias(f"count_{c}"), F.avg(c).alias(f"mean_{c}"),
            F.stddev_samp(c).alias(f"std_{c}"), F.min(c).cast("double").alias(f"min_{c}"),
            F.max(c).cast("double").alias(f"max_{c}"),
        ]
    quartiles = quantiles(df, [], {f"q_{c}": c for c in columns}, [0.25, 0.5, 0.75])
    joined = with_totals(df.agg(*parts), quartiles)
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{s}_{c}").alias(s) for s in ("count", "mean", "std", "min")],
                *[F.col(f"q_{c}")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
                F.col(f"max_{c}").alias("max"),
            )
            for c in columns
        ]
    )
    return joined.select(F.explode(lines).alias("r")).select("r.*")


def batch_size_summary(df: DataFrame, column: str = "batch_size") -> DataFrame:
    """(mean, std, median) of the recorded batch sizes."""
    middle = quantiles(df, [], {"_q": column}, [0.5])
    summary = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))
    return with_totals(summary, middle).select(
        "mean", "std", F.col("_q")[0].alias("median")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) for `bins` equal widths over the value range, empty bins included.

    Bins are half-open except the last, which holds the maximum.  A constant column gets a
    range of width one around its value.
    """
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))
        .cast("double").alias("_lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))
        .cast("double").alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.least(F.floor((F.col(column) - F.col("_lo")) / width) + 1, F.lit(bins))
    counts = (
        with_totals(df.filter(F.col(column).isNotNull()), ends)
        .groupBy(number.cast("int").alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    spine = ends.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return spine.join(F.broadcast(counts), F.col("bin") == F.col("_bin"), "left").select(
        "bin",
        (F.col("_lo") + width * (F.col("bin") - 1)).alias("low"),
        (F.col("_lo") + width * F.col("bin")).alias("high"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n"),
    )


def ingestion_lag(df: DataFrame, trade: str = "trade_ts", ingestion: str = "ingestion_ts"
                  ) -> DataFrame:
    """Add `time_to_ingest`: seconds from trade to ingestion."""
    gap = F.unix_micros(ingestion) - F.unix_micros(trade)
    return df.withColumn("time_to_ingest", gap / 1e6)


def moments(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, skewness, excess kurtosis), both in population form."""
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )


def normality(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """D'Agostino-Pearson test: (keys, n, z_skew, z_kurtosis, k2, p), NULL below 8 values."""
    table = moments(df, column, keys)
    n = F.col("n").cast("double")
    enough = (F.col("n") >= 8) & F.col("skewness").isNotNull() & ~F.isnan("skewness")
    scored = table.withColumns(
        {
            "z_skew": F.when(enough, _skew_score(F.col("skewness"), n)),
            "z_kurtosis": F.when(enough, _kurtosis_score(F.col("kurtosis"), n)),
        }
    )
    k2 = F.col("z_skew") * F.col("z_skew") + F.col("z_kurtosis") * F.col("z_kurtosis")
    return scored.withColumn("k2", k2).withColumn("p", F.exp(-F.col("k2") / 2)).drop(
        "skewness", "kurtosis"
    )


def _skew_score(g: Column, n: Column) -> Column:
    """D'Agostino (1970)."""
    y = g * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = (
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(2 * (beta - 1)) - 1
    return F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2))


def _kurtosis_score(excess: Column, n: Column) -> Column:
    """Anscombe and Glynn (1983)."""
    spread = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (excess + 3 - 3 * (n - 1) / (n + 1)) / F.sqrt(spread)
    skew = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / skew * (2 / skew + F.sqrt(1 + 4 / (skew * skew)))
    d = 1 + x * F.sqrt(2 / (a - 4))
    root = F.cbrt((1 - 2 / a) / F.abs(d))
    return (1 - 2 / (9 * a) - F.signum(d) * root) / F.sqrt(2 / (9 * a))


# Royston (1995), lowest power first.
LAST_WEIGHT = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
NEXT_WEIGHT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_LOG_STD = [-0.4803, -0.082676, 0.0030302]
SMALL_GAMMA = [-2.273, 0.459]
SMALL_MEAN = [0.5440, -0.39978, 0.025054, -0.0006714]
SMALL_LOG_STD = [1.3822, -0.77857, 0.062767, -0.0020322]
SMALL_UPTO = 11


def shapiro(df: DataFrame, column: str, keys: Sequence[str] = (), ties: Sequence[str] = ("uuid",)
            ) -> DataFrame:
    """Shapiro-Wilk test on all rows: (keys, n, w, z, p); NULL below 4 values.

    The statistic needs each value's rank, which is its position in value order, and sums of
    rank scores; nothing else about the order leaves the tasks.
    """
    rows = df.select(*keys, F.col(column).cast("double").alias("_x"), *ties).filter("_x IS NOT NULL")
    layout = plan_layout(rows, Series(tuple(keys), "_x", tuple(ties)))
    ranked = with_position(rows, layout, "_rank")
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.var_pop("_x") * F.count(F.lit(1))).alias("_ss")
    )
    joined = layout.attach(ranked, sizes, tuple(keys))
    n = F.col("n").cast("double")
    edge = F.when(F.col("n") > 5, 2).otherwise(1)
    from_top = F.col("n") - 1 - F.col("_rank")
    inside = (F.col("_rank") >= edge) & (from_top >= edge)
    m = F.col("_m")
    sums = (
        joined.withColumn("_m", normal_quantile((F.col("_rank") + 0.625) / (n + 0.25)))
        .groupBy(*keys)
        .agg(
            F.first("n").alias("n"),
            F.first("_ss").alias("_ss"),
            F.sum(m * m).alias("_mm"),
            F.sum(F.when(inside, m * F.col("_x")).otherwise(0.0)).alias("_mx"),
            *[
                F.max(F.when(at == place, F.col("_x"))).alias(f"_{end}{place}")
                for end, at in (("lo", F.col("_rank")), ("hi", from_top))
                for place in (0, 1)
            ],
        )
    )
    u, mm = 1 / F.sqrt(n), F.col("_mm")
    last_m = normal_quantile((n - 0.375) / (n + 0.25))
    next_m = normal_quantile((n - 1.375) / (n + 0.25))
    weights = sums.filter(F.col("n") >= 4).withColumns(
        {
            "_m_last": last_m,
            "_m_next": next_m,
            "_a_last": last_m / F.sqrt(mm) + polynomial(u, LAST_WEIGHT),
            "_a_next": F.when(F.col("n") > 5, next_m / F.sqrt(mm) + polynomial(u, NEXT_WEIGHT)),
        }
    )
    al, an = F.col("_a_last"), F.coalesce("_a_next", F.lit(0.0))
    ml = F.col("_m_last")
    mn = F.when(F.col("n") > 5, F.col("_m_next")).otherwise(0.0)
    phi = (mm - 2 * ml * ml - 2 * mn * mn) / (1 - 2 * al * al - 2 * an * an)
    top = (
        al * (F.col("_hi0") - F.col("_lo0"))
        + an * (F.col("_hi1") - F.col("_lo1"))
        + F.col("_mx") / F.sqrt(phi)
    )
    log_n, log_left = F.log(n), F.log(1 - F.col("w"))
    small = F.col("n") <= SMALL_UPTO
    small_z = (-F.log(polynomial(n, SMALL_GAMMA) - log_left) - polynomial(n, SMALL_MEAN)) / F.exp(
        polynomial(n, SMALL_LOG_STD)
    )
    large_z = (log_left - polynomial(log_n, LARGE_MEAN)) / F.exp(polynomial(log_n, LARGE_LOG_STD))
    return (
        weights.withColumn("w", F.try_divide(top * top, F.col("_ss")))
        .withColumn("z", F.when(F.col("w") < 1, F.when(small, small_z).otherwise(large_z)))
        .select(*keys, "n", "w", "z", normal_upper("z").alias("p"))
    )
