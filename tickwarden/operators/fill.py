"""Filling gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.functions.missing import number
from tickwarden.operators.series import Layout, Series, plan_layout, with_totals


def _present(column: str, place: Column) -> Column:
    """(place, value) where the value is there, else NULL."""
    value = number(column)
    return F.when(value.isNotNull(), F.struct(place.alias("at"), value.alias("x")))


def interpolate(
    df: DataFrame, columns: tuple[str, ...], series: Series = Series(),
    layout: Layout | None = None,
) -> DataFrame:
    """Fill NULLs linearly by row position; leading NULLs stay, trailing ones repeat the last.

    Each cell looks only at its own rows; the nearest value before and after it comes from a
    summary holding one row per cell.
    """
    layout = layout or plan_layout(df, series)
    keys = layout.cell_keys
    placed = layout.cells(df).withColumn("_at", F.row_number().over(layout.window).cast("long"))
    so_far = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # reading backwards keeps the running frame; a frame to the end would be quadratic
    to_come = Window.partitionBy(*keys).orderBy(F.desc("_at")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    near = placed.withColumns(
        {f"_prev_{c}": F.last(_present(c, F.col("_at")), True).over(so_far) for c in columns}
    ).withColumns(
        {f"_next_{c}": F.last(_present(c, F.col("_at")), True).over(to_come) for c in columns}
    )
    if not layout.single:
        near = _carry(near, placed, layout, columns)
    filled = {c: _blend(c) for c in columns}
    helpers = [f"_{side}_{c}" for side in ("prev", "next") for c in columns]
    return near.withColumns(filled).drop("_at", "_chunk", "_sub", *helpers)


def _blend(c: str) -> Column:
    value, prev, ahead = number(c), F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    share = F.try_divide(F.col("_at") - prev["at"], (ahead["at"] - prev["at"]).cast("double"))
    between = prev["x"] + (ahead["x"] - prev["x"]) * share
    return F.coalesce(value, F.when(ahead.isNull(), prev["x"]).otherwise(between))


def _carry(near: DataFrame, placed: DataFrame, layout: Layout, columns: tuple[str, ...]
           ) -> DataFrame:
    """Number rows through the whole series and bring in values from other cells."""
    ends = {}
    for c in columns:
        ends[f"_lo_{c}"] = F.min(_present(c, F.col("_at")))
        ends[f"_hi_{c}"] = F.max(_present(c, F.col("_at")))
    cells = placed.groupBy(*layout.cell_keys).agg(
        F.count(F.lit(1)).alias("_size"), *[e.alias(n) for n, e in ends.items()]
    )
    order = layout.prior_cells()
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    backwards = Window.partitionBy(*layout.series.keys).orderBy(F.desc("_chunk"), F.desc("_sub"))
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)

    def shifted(name: str) -> Column:
        at = (F.col(name)["at"] + F.col("_offset")).alias("at")
        return F.when(F.col(name).isNotNull(), F.struct(at, F.col(name)["x"].alias("x")))

    cells = cells.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    carried = cells.select(
        *layout.cell_keys,
        "_offset",
        *[F.last(shifted(f"_hi_{c}"), True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.last(shifted(f"_lo_{c}"), True).over(later).alias(f"_after_{c}") for c in columns],
    )
    joined = layout.attach(near, carried, layout.cell_keys)
    exact = {"_at": F.col("_at") + F.col("_offset")}
    for c in columns:
        exact[f"_prev_{c}"] = F.coalesce(shifted(f"_prev_{c}"), F.col(f"_before_{c}"))
        exact[f"_next_{c}"] = F.coalesce(shifted(f"_next_{c}"), F.col(f"_after_{c}"))
    helpers = [f"_{side}_{c}" for side in ("before", "after") for c in columns]
    return joined.withColumns(exact).drop("_offset", *helpers)


def fill_with_mean(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Fill what is still NULL with the column's mean over the whole table."""
    means = df.agg(*[F.avg(number(c)).alias(f"_mean_{c}") for c in columns])
    filled = with_totals(df, means).withColumns(
        {c: F.coalesce(number(c), F.col(f"_mean_{c}")) for c in columns}
    )
    return filled.drop(*[f"_mean_{c}" for c in columns])


def fill_with_zero(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Every NULL in the named (default: all numeric and boolean) columns becomes 0 or false."""
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    numbers = [c for c in names if kinds[c] != "boolean"]
    flags = [c for c in names if kinds[c] == "boolean"]
    filled = df.fillna(0, numbers) if numbers else df
    return filled.fillna(False, flags) if flags else filled
