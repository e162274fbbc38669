"""Exact per-group quantiles that never hold a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwarden.operators.series import Layout, Series, attach, count_groups, plan_layout


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    probs: Sequence[float],
    discrete: bool = False,
    chunk_rows: int | None = None,
    known: tuple[int, int, int] | None = None,
) -> DataFrame:
    """(keys, one array per entry of `columns`): its quantile at each probability.

    `columns` maps result names to source columns.  Linear interpolation by default;
    `discrete` takes the smallest value whose cumulative share reaches the probability.
    NULLs are ignored.  `known` is what `count_groups` gives, if it was called already.
    """
    keys = list(keys)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(n) for n, c in columns.items()])
    known = known or count_groups(rows, keys)
    layouts = {}
    for name in columns:
        layouts[name] = plan_layout(rows, Series(tuple(keys), name, ()), chunk_rows, known)
    if all(layout.single for layout in layouts.values()):
        return rows.groupBy(*keys).agg(*[_direct(n, probs, discrete).alias(n) for n in columns])
    result = None
    for name, layout in layouts.items():
        one = rows.select(*keys, F.col(name).alias("_x")).filter("_x IS NOT NULL")
        found = _by_rank(one, keys, layout, probs, name, discrete)
        result = found if result is None else layout.attach(result, found, keys)
    return result


def _direct(column: str, probs: Sequence[float], discrete: bool) -> Column:
    if discrete:
        return F.array(
            *[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})") for p in probs]
        )
    return F.percentile(column, [float(p) for p in probs])


def _ranks(p: float, discrete: bool) -> tuple[Column, Column, Column]:
    """Lower and upper 0-based rank of one probability in `_n` values, and the blend."""
    if discrete:
        rank = F.greatest(F.ceil(F.lit(p) * F.col("_n")) - 1, F.lit(0)).cast("long")
        return rank, rank, F.lit(0.0)
    exact = F.lit(p) * (F.col("_n") - 1)
    low = F.floor(exact).cast("long")
    return low, F.ceil(exact).cast("long"), exact - low


def _between(low: Column, high: Column, blend: Column) -> Column:
    """The blend of two values; exactly the value where they are equal."""
    return F.when(low == high, low).otherwise(low * (1.0 - blend) + high * blend)


def _by_rank(
    rows: DataFrame,
    keys: list[str],
    layout: Layout,
    probs: Sequence[float],
    name: str,
    discrete: bool,
) -> DataFrame:
    """Find the value slices holding the wanted ranks, then rank only inside those.

    The two counts combine map-side and no full-table shuffle happens; equal values are
    folded into one counted row before any slice is ordered.
    """
    sliced = layout.chunk(rows, {"_chunk": F.col("_x")})
    wanted = [_ranks(p, discrete) for p in probs]
    in_order = Window.partitionBy(*keys).orderBy("_chunk")
    ranks = F.array_distinct(F.array(*[r for low, high, _ in wanted for r in (low, high)]))
    slices = (
        sliced.groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_n", F.sum("_size").over(Window.partitionBy(*keys)))
        .withColumn("_end", F.sum("_size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("_size"))
        .withColumn(
            "_ranks",
            F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_end"))),
        )
        .filter(F.size("_ranks") > 0)
        .drop("_size", "_end")
    )
    found_slices = min(layout.rows, layout.groups * 2 * len(probs))
    inside = attach(
        sliced, slices, [*keys, "_chunk"], found_slices, layout.broadcast_rows
    ).filter(F.col("_ranks").isNotNull())
    running = Window.partitionBy(*keys, "_chunk").orderBy("_x")
    values = (
        inside.groupBy(*keys, "_chunk", "_start", "_n", "_ranks", "_x")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn(
            "_upto",
            F.col("_start")
            + F.sum("_copies").over(running.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn(
            "_rank",
            F.explode(
                F.filter(
                    "_ranks",
                    lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_copies")),
                )
            ),
        )
    )
    picked = values.groupBy(*keys).agg(
        F.first("_n").alias("_n"),
        F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"),
    )
    return picked.select(
        *keys,
        F.array(
            *[
                _between(F.element_at("_at", low), F.element_at("_at", high), blend)
                for low, high, blend in wanted
            ]
        ).alias(name),
    )
