"""Classical seasonal decomposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwarden.operators.series import Layout, Series, attach, plan_layout, sliding, with_position

COMPONENTS = ("observed", "trend", "seasonal", "resid")


def decompose(
    df: DataFrame,
    column: str,
    period: int,
    model: str = "additive",
    series: Series = Series(),
    layout: Layout | None = None,
) -> DataFrame:
    """Add observed, trend, seasonal and resid.

    The trend is a centred moving mean (half weights at both ends for an even period) and is
    NULL for half a period at either end.  The seasonal part is the mean of the detrended
    values per phase, centred over the phases.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError("model is additive or multiplicative")
    layout = layout or plan_layout(df, series)
    half = period // 2
    x = F.col("observed")

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-half, half)
        total, seen = F.sum("observed").over(frame), F.count("observed").over(frame)
        if period % 2 == 0:
            ends = F.lag("observed", half).over(w) + F.lead("observed", half).over(w)
            total = total - 0.5 * ends
        return d.withColumn("trend", F.when(seen == 2 * half + 1, total / period))

    placed = with_position(df, layout, "_pos").withColumn("observed", F.col(column).cast("double"))
    trended = sliding(placed, layout, half, half, add, "_pos").withColumn(
        "_phase", (F.col("_pos") % period).cast("int")
    )
    apart = x - F.col("trend") if model == "additive" else F.try_divide(x, F.col("trend"))
    phases = trended.groupBy(*series.keys, "_phase").agg(F.avg(apart).alias("_raw"))
    centre = phases.groupBy(*series.keys).agg(F.avg("_raw").alias("_centre"))
    shift = (
        F.col("_raw") - F.col("_centre")
        if model == "additive"
        else F.try_divide(F.col("_raw"), F.col("_centre"))
    )
    seasons = attach(
        phases, centre, series.keys, layout.groups, layout.broadcast_rows
    ).select(*series.keys, "_phase", shift.alias("seasonal"))
    joined = attach(
        trended, seasons, (*series.keys, "_phase"), layout.groups * period, layout.broadcast_rows
    )
    return joined.withColumn("resid", _rest(model)).drop("_pos", "_phase")


def _rest(model: str) -> Column:
    x, trend, seasonal = (F.col(c) for c in COMPONENTS[:3])
    if model == "additive":
        return x - trend - seasonal
    return F.try_divide(x, trend * seasonal)


def components_long(df: DataFrame, ids: list[str]) -> DataFrame:
    """(ids, component, value), in the usual order of the components."""
    long = df.unpivot(ids, list(COMPONENTS), "component", "value")
    return long.withColumn(
        "component_no", F.array_position(F.lit(list(COMPONENTS)), F.col("component")).cast("int")
    )
