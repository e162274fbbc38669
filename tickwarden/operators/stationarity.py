"""Augmented Dickey-Fuller test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session
from tickwarden.operators.series import Series, blocks, for_python, plan_layout

# MacKinnon (1994) p-value surface and (2010) critical values, constant term,
# lowest power first.
P_SMALL = [2.1659, 1.4412, 0.038269]
P_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
P_SWITCH, P_MAX, P_MIN = -1.61, 2.74, -18.83
CRITICAL = {
    "crit_1pct": [-3.43035, -6.5393, -16.786, -79.433],
    "crit_5pct": [-2.86154, -2.8903, -4.234, -40.040],
    "crit_10pct": [-2.56677, -1.5384, -2.809, 0.0],
}
# Rows of the regression design held at a time.
SLICE = 20_000


def default_max_lag(rows: int) -> int:
    return max(0, min(math.ceil(12 * (rows / 100) ** 0.25), rows // 2 - 2))


def p_value(statistic: float) -> float:
    if statistic > P_MAX:
        return 1.0
    if statistic < P_MIN:
        return 0.0
    surface = P_SMALL if statistic <= P_SWITCH else P_LARGE
    z = np.polynomial.polynomial.polyval(statistic, surface)
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def design(x: np.ndarray, lags: int) -> np.ndarray:
    """Rows (1, previous level, `lags` lagged differences, difference) for x[lags + 1:]."""
    windows = np.lib.stride_tricks.sliding_window_view(x, lags + 2)
    steps = np.diff(windows, axis=1)
    return np.column_stack(
        [np.ones(len(windows)), windows[:, -2], steps[:, :-1][:, ::-1], steps[:, -1]]
    )


def eliminated(products: np.ndarray):
    """The cross products after taking out one regressor after the other, the last column being what is explained.

    After k steps the last entry is the residual sum of squares of the model with the first k regressors, so one
    elimination serves all lags.  A regressor that the earlier ones explain takes nothing out.
    """
    left, least = products.copy(), 1e-12 * np.abs(np.diag(products)).max(initial=0)
    for k in range(len(left) - 1):
        if left[k, k] > least:
            left = left - np.outer(left[:, k], left[k]) / left[k, k]
        yield left


def _level_t(products: np.ndarray, lags: int, observed: float) -> float:
    """t of the level in the model with `lags` differences: the level is taken out last."""
    order = [0, *range(2, lags + 2), 1, lags + 2]
    *_, left, _ = eliminated(products[np.ix_(order, order)])
    own, both, rest = left[-2, -2], left[-2, -1], left[-1, -1]
    if own <= 1e-12 * abs(products[1, 1]):
        return math.nan
    ssr = rest - both * both / own
    spread = ssr / (observed - lags - 2) / own
    return float(both / own / math.sqrt(spread)) if spread > 0 else math.nan


def solve(gram: np.ndarray, head: np.ndarray, rows: int, max_lag: int, auto: bool) -> tuple:
    """Choose the lag by AIC on the common sample, then refit on every usable row."""
    common = rows - 1 - max_lag
    best = max_lag
    if auto:
        squares = [left[-1, -1] for left in eliminated(gram)][1:]

        def aic(k: int) -> float:
            return common * (math.log(2 * math.pi * max(squares[k], 1e-300) / common) + 1) + 2 * (k + 2)

        best = min(range(max_lag + 1), key=lambda k: (aic(k), k))
    use = [*range(best + 2), gram.shape[0] - 1]
    full = gram[np.ix_(use, use)]
    if best < max_lag:  # rows the longer lags could not use
        extra = design(head, best)[: max_lag - best]
        full = full + extra.T @ extra
    observed = rows - 1 - best
    return _level_t(full, best, observed), best, observed


def adf(df: DataFrame, column: str, series: Series = Series(), max_lag: int | None = None,
        auto: bool = True) -> DataFrame:
    """(keys, n, statistic, p, used_lag, observations, critical values, stationary).

    Each block of rows adds up its part of the regression's cross products; only those sums
    and the first few values of a series reach the solver, whatever the series' length.
    """
    rows, series, restore = for_python(df.filter(F.col(column).isNotNull()), series)
    keys = list(series.keys)
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(column).alias("_mean"),
        F.stddev_pop(column).alias("_std"),
    )
    longest = stats.agg(F.max("_n")).first()[0] or 0
    reach = default_max_lag(longest) if max_lag is None else max_lag
    layout = plan_layout(rows, series, session.python_rows(rows.sparkSession))
    slim = rows.select(*dict.fromkeys((*keys, *series.order)), F.col(column).alias("_v"))
    # a shift and a scale change neither the statistic nor the choice of lag
    scaled = layout.attach(slim, stats, keys).withColumn(
        "_x", F.coalesce(F.try_divide(F.col("_v") - F.col("_mean"), F.col("_std")), F.lit(0.0))
    )
    cut, group = blocks(scaled, layout, reach + 1, 0, "_pos")
    cut = cut.select(*keys, "_block", "_home", "_pos", "_n", "_x")

    def lag_of(n: int) -> int:
        return min(reach, max(0, n // 2 - 2)) if max_lag is not None else default_max_lag(n)

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        n = int(pdf["_n"].iloc[0])
        lags = lag_of(n)
        x, pos = pdf["_x"].to_numpy(), pdf["_pos"].to_numpy()
        own = (pdf["_home"] == pdf["_block"]).to_numpy() & (pos >= lags + 1)
        gram = np.zeros((lags + 3, lags + 3))
        ends = np.flatnonzero(own)
        for at in range(0, len(ends), SLICE):
            part = ends[at : at + SLICE]
            z = design(x[part[0] - lags - 1 : part[-1] + 1], lags)
            gram += z.T @ z
        head = (pos <= lags) & (pdf["_home"] == pdf["_block"]).to_numpy()
        upper = gram[np.triu_indices(lags + 3)]
        index = np.concatenate([np.arange(len(upper)), -1 - pos[head]])
        value = np.concatenate([upper, x[head]])
        made = pd.DataFrame({"_i": index, "_value": value, "_n": n})
        for k in keys:
            made[k] = pdf[k].iloc[0]
        return made

    key_fields = [rows.schema[k] for k in keys]
    partial_type = T.StructType(
        [
            *key_fields, T.StructField("_n", T.LongType()), T.StructField("_i", T.LongType()),
            T.StructField("_value", T.DoubleType()),
        ]
    )
    sums = (
        cut.groupBy(*group).applyInPandas(partial, partial_type)
        .groupBy(*keys, "_n", "_i").agg(F.sum("_value").alias("_value"))
    )

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_n"].iloc[0])
        lags = lag_of(n)
        ordered = pdf.sort_values("_i")
        index, value = ordered["_i"].to_numpy(), ordered["_value"].to_numpy()
        gram = np.zeros((lags + 3, lags + 3))
        gram[np.triu_indices(lags + 3)] = value[index >= 0]
        gram = gram + np.triu(gram, 1).T
        head = value[index < 0][::-1]
        try:
            statistic, used, observed = solve(gram, head, n, lags, auto)
        except (np.linalg.LinAlgError, ZeroDivisionError, ValueError):
            statistic, used, observed = math.nan, lags, n - 1 - lags
        line = {k: pdf[k].iloc[0] for k in keys}
        known = not math.isnan(statistic)
        line |= {
            "n": n, "statistic": statistic if known else None,
            "p": p_value(statistic) if known else None, "used_lag": used, "observations": observed,
        }
        for name, terms in CRITICAL.items():
            line[name] = (
                float(np.polynomial.polynomial.polyval(1.0 / observed, terms)) if observed > 0 else None
            )
        return pd.DataFrame([line])

    result_type = T.StructType(
        [
            *key_fields, T.StructField("n", T.LongType()), T.StructField("statistic", T.DoubleType()),
            T.StructField("p", T.DoubleType()), T.StructField("used_lag", T.IntegerType()),
            T.StructField("observations", T.LongType()),
            *[T.StructField(c, T.DoubleType()) for c in CRITICAL],
        ]
    )
    tested = sums.groupBy(*keys).applyInPandas(finish, result_type)
    return restore(tested.withColumn("stationary", F.col("p") <= 0.05))
