"""Judging detectors: confusion matrices, metrics and agreement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.functions.missing import number
from tickwarden.operators.detectors import detect, flag_name
from tickwarden.operators.scope import Scope, whole
from tickwarden.operators.series import Series

# Cell names in row order (truth rows, prediction columns).
CELLS = ("True Neg", "False Pos", "False Neg", "True Pos")


def _on(column: str) -> Column:
    """A 0/1 or boolean label; NULL counts as 0."""
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0)) != 0


def confusion(df: DataFrame, truth: str, prediction: str, keys: Sequence[str] = (),
              swap: bool = False) -> DataFrame:
    """(keys, tn, fp, fn, tp), all four always present.

    `swap` exchanges the roles of the two columns, so fp and fn change places.
    """
    if swap:
        truth, prediction = prediction, truth
    t, p = _on(truth), _on(prediction)
    return df.groupBy(*keys).agg(
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
    )


def labelled_cells(matrix: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per cell: name, count, share in percent and the text `name count share%`."""
    counts = ["tn", "fp", "fn", "tp"]
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("cell"), F.col(c).alias("n"), total.alias("_total"))
            for name, c in zip(CELLS, counts)
        ]
    )
    share = F.round(F.try_divide(F.lit(100.0) * F.col("n"), F.col("_total")), 2)
    long = matrix.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")
    return long.withColumn("share_pct", share).withColumn(
        "label", F.format_string("%s %d %.2f%%", "cell", "n", "share_pct")
    ).drop("_total")


def metrics(matrix: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, accuracy, precision, recall, f1); a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def ratio(top: Column, base: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), base.cast("double")), F.lit(0.0))

    return matrix.select(
        *keys,
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def join_predictions(base: DataFrame, predictions: DataFrame, columns: Sequence[str],
                     on: str = "uuid") -> DataFrame:
    """Bring predictions to their rows by id; rows without one get 0.

    An id predicted more than once counts by its largest value, so no row is multiplied.
    """
    slim = predictions.groupBy(on).agg(*[F.max(c).alias(c) for c in columns])
    joined = base.join(slim, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def agreement(df: DataFrame, method: str, scope: Scope = whole(), series: Series = Series(),
              stored: Mapping[str, str] | None = None, missing: float | None = 0.0, **params) -> DataFrame:
    """Compare stored predictions with the same detector run again.

    `stored` maps each value column to its prediction column.  Gives one row per value
    column with the confusion counts and metrics.  Values that are NULL or NaN count as `missing` when the detector
    runs again; with None they stay out of its statistics.
    """
    stored = stored or {"price": "price_pred", "volume": "volume_pred"}
    if missing is not None:
        df = df.withColumns({c: F.coalesce(number(c), F.lit(float(missing))) for c in stored})
    redone = detect(df, method, tuple(stored), scope, series, **params)
    return _per_column(redone, {c: (p, flag_name(c)) for c, p in stored.items()})


def _per_column(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Confusion counts and metrics of several (truth, prediction) pairs in one scan."""
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"), _on(t).alias("truth"), _on(p).alias("prediction")
            )
            for name, (t, p) in pairs.items()
        ]
    )
    long = df.select(F.explode(lines).alias("l")).select("l.*")
    matrix = confusion(long, "truth", "prediction", ["column"])
    kept = [F.col(c) for c in ("tn", "fp", "fn", "tp")]
    return metrics(matrix, ["column", *kept])


def compare_methods(df: DataFrame, runs: Mapping[str, Mapping], truth: Mapping[str, str],
                    scope: Scope = whole(), series: Series = Series()) -> DataFrame:
    """Several detectors on the same rows: metrics per (method, column).

    `runs` maps a name to {"method": ..., other parameters}; `truth` maps each value column
    to its label.  The rows are stored first, as every detector reads them several times.
    """
    parts, df = [], session.stored(df, "compared-rows")
    for name, settings in runs.items():
        params = dict(settings)
        flagged = detect(
            df, params.pop("method", name), tuple(truth), params.pop("scope", scope), series, **params
        )
        scored = _per_column(flagged, {c: (t, flag_name(c)) for c, t in truth.items()})
        parts.append(scored.withColumn("method", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)
