"""Anomaly detectors.

Each takes a table, the columns to judge and a scope, and adds one boolean
`<column>_flag` per column.  Undefined statistics (one row, constant values, NULLs)
never flag.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwarden.functions.missing import without_nan
from tickwarden.operators.arima import arima
from tickwarden.operators.iforest import iforest
from tickwarden.operators.peaks import prominence
from tickwarden.operators.quantiles import quantiles
from tickwarden.operators.scope import Scope, Scoped, scoped, whole
from tickwarden.operators.series import Series, plan_layout, sliding
from tickwarden.operators.trailing import MICROS, trailing_scores

# Columns of an anomaly record, with the settings that produced it.
RECORD = ("uuid", "price", "volume", "ingestion_ts", "symbol", "threshold", "window_size", "trade_ts")


def flag_name(column: str) -> str:
    return f"{column}_flag"


def settled(condition: Column) -> Column:
    """Unknown counts as not anomalous."""
    return F.coalesce(condition, F.lit(False))


def _within(s: Scoped, columns: Sequence[str], stats: Callable[[str], dict[str, Column]],
            judge: Callable[[str], Column]) -> DataFrame:
    """Judge rows against per-scope aggregates.

    Short scopes are windowed; others are aggregated map-side and joined back, so a hot
    scope is never gathered in one task.
    """
    named = {n: c for column in columns for n, c in stats(column).items()}
    if s.bounded:
        over = Window.partitionBy(*s.keys)
        with_stats = s.df.withColumns({n: c.over(over) for n, c in named.items()})
    else:
        table = s.df.groupBy(*s.keys).agg(*[c.alias(n) for n, c in named.items()])
        with_stats = s.attach(table).df
    return with_stats.withColumns(
        {flag_name(c): settled(judge(c)) for c in columns}
    ).drop(*named)


def zscore(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
           series: Series = Series(), threshold: float = 3.0) -> DataFrame:
    """Flag values more than `threshold` sample deviations from the scope mean.

    With n rows in a scope the score cannot exceed (n-1)/sqrt(n), so a threshold of 3
    needs scopes of at least 11 rows.
    """
    return _within(
        scoped(df, series, scope),
        columns,
        lambda c: {f"_mean_{c}": F.avg(c), f"_std_{c}": F.stddev_samp(c)},
        lambda c: F.abs(F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}")))
        > threshold,
    )


def iqr(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
        series: Series = Series(), factor: float = 1.5) -> DataFrame:
    """Flag values beyond `factor` interquartile ranges outside the quartiles."""
    s = scoped(df, series, scope)
    quartiles = [0.25, 0.75]

    def outside(c: str) -> Column:
        low, high = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        reach = (high - low) * factor
        return (F.col(c) < low - reach) | (F.col(c) > high + reach)

    if s.bounded:
        return _within(s, columns, lambda c: {f"_q_{c}": F.percentile(c, quartiles)}, outside)
    s = s.count()
    names = {f"_q_{c}": c for c in columns}
    joined = s.attach(quantiles(s.df, s.keys, names, quartiles, known=s.counted)).df
    return joined.withColumns({flag_name(c): settled(outside(c)) for c in columns}).drop(*names)


def mad(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
        series: Series = Series(), threshold: float = 3.0,
        center: str | None = "price") -> DataFrame:
    """Flag values more than `threshold` median absolute deviations from the median.

    Medians are the lower of the two middle values and no normal-consistency factor is
    applied.  The median is that of `center` for every column; pass None to use each
    column's own.
    """
    s = scoped(df, series, scope).count()
    middles = {f"_mid_{c}": c for c in ([center] if center else columns)}
    medians = quantiles(s.df, s.keys, middles, [0.5], discrete=True, known=s.counted)
    away = {
        f"_away_{c}": F.abs(F.col(c) - F.col(f"_mid_{center or c}")[0]) for c in columns
    }
    s = s.attach(medians).with_columns(away)
    spreads = {f"_mad_{c}": f"_away_{c}" for c in columns}
    table = quantiles(s.df, s.keys, spreads, [0.5], discrete=True, known=s.counted)
    flags = {
        flag_name(c): settled(F.try_divide(F.col(f"_away_{c}"), F.col(f"_mad_{c}")[0]) > threshold)
        for c in columns
    }
    return s.attach(table).df.withColumns(flags).drop(*middles, *away, *spreads)


def neighbour(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
              series: Series = Series(), threshold: float = 1.0) -> DataFrame:
    """Flag rows above (below) both neighbours and by more than `threshold` over the lower
    (under the higher) of them.  The first and last row of a scope are never flagged."""
    s = scoped(df, series, scope)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        flags = {}
        for c in columns:
            x, back, ahead = F.col(c), F.lag(c).over(w), F.lead(c).over(w)
            peak = (x > back) & (x > ahead) & (x - F.least(back, ahead) > threshold)
            valley = (x < back) & (x < ahead) & (F.greatest(back, ahead) - x > threshold)
            # least and greatest skip NULLs, but the comparisons above already fail on them
            flags[flag_name(c)] = settled(peak | valley)
        return d.withColumns(flags)

    if s.bounded:
        return add(s.df, Window.partitionBy(*s.keys).orderBy(*series.order))
    return sliding(s.df, plan_layout(s.df, s.inner), 1, 1, add)


def sliding_zscore(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
                   series: Series = Series(), seconds: float = 3, threshold: float = 3.0,
                   peers: bool = True) -> DataFrame:
    """Flag values whose score against the trailing time window exceeds `threshold`.

    `peers`: whether a row's window holds all rows of its instant, or only those before it.
    """
    s = scoped(df, series, scope)
    scored = trailing_scores(s.df, columns, [seconds], s.inner, peers)
    flags = {flag_name(c): settled(F.abs(F.col(f"{c}_z")) > threshold) for c in columns}
    return scored.withColumns(flags).drop("window_no", *[f"{c}_z" for c in columns])


def sweep(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[float, float]],
          series: Series = Series()) -> DataFrame:
    """(window_seconds, threshold, <column>_count, <column>_pct) for each configuration."""
    settings = F.array(
        *[
            F.struct(F.lit(float(w)).alias("seconds"), F.lit(float(t)).alias("limit"))
            for w, t in pairs
        ]
    )
    scored = trailing_scores(df, columns, [w for w, _ in pairs], series).withColumn(
        "_set", F.element_at(settings, F.col("window_no") + 1)
    )
    parts = []
    for c in columns:
        hit = settled(F.abs(F.col(f"{c}_z")) > F.col("_set")["limit"])
        parts.append(F.count_if(hit).alias(f"{c}_count"))
        parts.append((100.0 * F.avg(hit.cast("double"))).alias(f"{c}_pct"))
    return scored.groupBy(
        F.col("_set")["seconds"].alias("window_seconds"), F.col("_set")["limit"].alias("threshold")
    ).agg(*parts)


def legacy_rows(df: DataFrame, threshold: float, window_size: int) -> DataFrame:
    """The anomaly record layout with the settings that produced it as constants."""
    constants = {"threshold": F.lit(float(threshold)), "window_size": F.lit(int(window_size))}
    return df.withColumns(constants).select(*RECORD)


def run_configurations(df: DataFrame, windows: Sequence[int], threshold: float, column: str,
                       method: str, series: Series = Series()) -> DataFrame:
    """One detector over tumbling event-time windows of several lengths, as one job.

    Each row is repeated once per window length; `window_size` and `threshold` tell the
    configurations apart in the result.
    """
    sizes = F.array(*[F.lit(int(w)) for w in windows])
    micros = F.unix_micros(series.time)
    wide = df.withColumn("window_size", F.explode(sizes))
    wide = wide.withColumn(
        "_frame", F.floor(micros / (F.col("window_size").cast("long") * F.lit(MICROS)))
    )
    inner = Series((*series.keys, "window_size", "_frame"), series.time, series.ties)
    flagged = DETECTORS[method](wide, [column], whole(), inner, threshold=threshold)
    hits = flagged.filter(F.col(flag_name(column)))
    return hits.withColumn("threshold", F.lit(float(threshold))).select(*RECORD)


def enrich(df: DataFrame, method: str, scope: Scope = whole(), series: Series = Series(),
           **params) -> DataFrame:
    """Price and volume flags together, over one scope."""
    return detect(df, method, ("price", "volume"), scope, series, **params)


def detect(df: DataFrame, method: str, columns: Sequence[str] = ("price", "volume"),
           scope: Scope = whole(), series: Series = Series(), **params) -> DataFrame:
    """Run the named detector; the same call serves tables and micro-batches.

    NaN in the judged columns counts as missing and comes back as NULL.
    """
    if method not in DETECTORS:
        raise ValueError(f"unknown detector {method!r}; known: {sorted(DETECTORS)}")
    return DETECTORS[method](without_nan(df, columns), columns, scope, series, **params)


DETECTORS: dict[str, Callable[..., DataFrame]] = {
    "zscore": zscore,
    "iqr": iqr,
    "mad": mad,
    "neighbour": neighbour,
    "sliding": sliding_zscore,
    "prominence": prominence,
    "arima": arima,
    "iforest": iforest,
}
