"""Autocorrelation and partial autocorrelation of ordered series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwarden.operators.series import Series, plan_layout, sliding

# Fixed value: normal quantile used for the 95 % bands.
BAND = 1.96


def default_lags(rows: int) -> int:
    """10 log10(n) lags rounded up, at most half the series."""
    return min(math.ceil(10 * math.log10(rows)), rows // 2) if rows > 1 else 0


def _acf_arrays(df: DataFrame, column: str, series: Series, lags: int | None) -> DataFrame:
    """(keys, n, _r): autocorrelations from lag 0 on, over the full-series variance.

    All lagged products come from one window and one map-side combined aggregate.
    """
    rows = df.filter(F.col(column).isNotNull())
    stats = rows.groupBy(*series.keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(column).alias("_mean")
    )
    layout = plan_layout(rows, series)
    if lags is None:
        longest = stats.agg(F.max("n")).first()[0] or 0
        lags = default_lags(longest)
    centred = layout.attach(
        rows.select(*dict.fromkeys((*series.keys, *series.order)), F.col(column).alias("_v")),
        stats.drop("n"), series.keys,
    ).withColumn("_c", F.col("_v") - F.col("_mean"))

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns({f"_c{k}": F.lag("_c", k).over(w) for k in range(1, lags + 1)})

    lagged = sliding(centred, layout, lags, 0, add)
    products = [F.sum(F.col("_c") * F.col(f"_c{k}" if k else "_c")) for k in range(lags + 1)]
    sums = lagged.groupBy(*series.keys).agg(
        F.count(F.lit(1)).alias("n"), *[p.alias(f"_s{k}") for k, p in enumerate(products)]
    )
    ratios = F.array(*[F.try_divide(F.col(f"_s{k}"), F.col("_s0")) for k in range(lags + 1)])
    return sums.select(*series.keys, "n", ratios.alias("_r"))


def acf(df: DataFrame, column: str, series: Series = Series(), lags: int | None = None
        ) -> DataFrame:
    """(keys, lag, acf, band): Bartlett's band grows with the correlations before the lag."""
    arrays = _acf_arrays(df, column, series, lags)
    squares = F.aggregate(
        F.slice(F.col("_r"), 2, F.greatest(F.col("lag") - 1, F.lit(0))),
        F.lit(0.0), lambda a, r: a + r * r,
    )
    long = arrays.select(*series.keys, "n", "_r", F.posexplode("_r").alias("lag", "acf"))
    band = F.when(F.col("lag") > 0, BAND * F.sqrt((1 + 2 * squares) / F.col("n"))).otherwise(0.0)
    return long.filter(F.col("acf").isNotNull()).select(
        *series.keys, "lag", "acf", band.alias("band")
    )


def _durbin_levinson(r: Column, lags: Column) -> Column:
    """Partial autocorrelations of lags 1.. from the autocorrelations, as an array.

    Folded over the lags with built-in array functions: the state is the coefficients of the
    current order, the remaining variance share and the results so far.
    """
    doubles = "array<double>"
    start = F.struct(
        F.array().cast(doubles).alias("phi"), F.lit(1.0).alias("left"),
        F.array().cast(doubles).alias("out"),
    )

    def step(state: Column, k: Column) -> Column:
        earlier = F.reverse(F.slice(r, F.lit(2), k - 1))
        explained = F.aggregate(
            F.zip_with(state["phi"], earlier, lambda a, b: a * b),
            F.lit(0.0), lambda total, x: total + x,
        )
        last = F.try_divide(F.element_at(r, k + 1) - explained, state["left"])

        def advance(p: Column) -> Column:
            kept = F.zip_with(state["phi"], F.reverse(state["phi"]), lambda a, b: a - p * b)
            return F.struct(
                F.concat(kept, F.array(p)).alias("phi"),
                (state["left"] * (1 - p * p)).alias("left"),
                F.concat(state["out"], F.array(p)).alias("out"),
            )

        # transform binds the new coefficient once instead of repeating its expression
        return F.transform(F.array(last), advance)[0]

    return F.aggregate(F.sequence(F.lit(1), lags), start, step, lambda state: state["out"])


def pacf(df: DataFrame, column: str, series: Series = Series(), lags: int | None = None
         ) -> DataFrame:
    """(keys, lag, pacf, band) by Yule-Walker, lag 0 included as 1."""
    arrays = _acf_arrays(df, column, series, lags).filter(F.size("_r") > 1)
    solved = arrays.withColumn("_p", _durbin_levinson(F.col("_r"), F.size("_r") - 1))
    full = F.concat(F.array(F.lit(1.0)), F.col("_p"))
    return (
        solved.select(*series.keys, "n", F.posexplode(full).alias("lag", "pacf"))
        .filter(F.col("pacf").isNotNull())
        .select(
            *series.keys, "lag", "pacf",
            F.when(F.col("lag") > 0, BAND / F.sqrt("n")).otherwise(0.0).alias("band"),
        )
    )
