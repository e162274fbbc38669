"""Peaks and valleys by prominence, on series of any length.

A local maximum of height h has prominence of at least p when, going outward on each side, a
value of h - p or less comes before any value above h.  For one side the least h that
qualifies follows a running clamp: after a value x it becomes min(max(level, x), x + p).
Clamps compose to clamps, so a chunk of the series is summed up in two numbers, and chunks
need only the clamp of everything before (or after) them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session
from tickwarden.operators.scope import Scope, scoped, whole
from tickwarden.operators.series import (
    Layout,
    Series,
    attach,
    for_python,
    plan_layout,
    sliding,
    with_position,
)

START = math.inf  # nothing seen yet: no height qualifies
SIDES = ("peak_left", "peak_right", "valley_left", "valley_right")


def levels(values: Iterable[float], prominence: float, level: float) -> list[float]:
    """The least qualifying height just before each value, starting from `level`."""
    out = []
    for x in values:
        out.append(level)
        level = min(max(level, x), x + prominence)
    return out


def summary(values: Iterable[float], prominence: float) -> tuple[float, float]:
    """The clamp (low, high) that a run of values amounts to."""
    low, high = -math.inf, math.inf
    for x in values:
        low = min(max(low, x), x + prominence)
        high = min(max(high, x), x + prominence)
    return low, high


def _sides(x: np.ndarray, peaks: float, valleys: float) -> list[tuple[list[float], float]]:
    up, down = x.tolist(), (-x).tolist()
    return [(up, peaks), (up[::-1], peaks), (down, valleys), (down[::-1], valleys)]


def _turns(rows: DataFrame, layout: Layout) -> DataFrame:
    """Turning points of a series: (keys, pos, x, shape, mid).

    Equal neighbours are one run; `mid` is the middle row of the run, and shape is 1 for a
    maximum, -1 for a minimum, 0 for an end of the series.
    """
    keys = layout.series.keys
    starts = sliding(
        rows, layout, 1, 0, lambda d, w: d.withColumn("_back", F.lag("_x").over(w)), "_pos"
    ).filter(F.col("_back").isNull() | (F.col("_back") != F.col("_x")))
    runs = starts.select(*keys, "_pos", "_x")
    known = layout.counted if layout.single else None
    if not layout.single:
        runs = session.stored(runs, "runs")
    inner = plan_layout(runs, Series(keys, "_pos", ()), layout.chunk_rows, known)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns(
            {
                "_prev": F.lag("_x").over(w),
                "_next": F.lead("_x").over(w),
                "_mid": F.floor((F.col("_pos") + F.lead("_pos").over(w) - 1) / 2).cast("long"),
            }
        )

    x, back, ahead = F.col("_x"), F.col("_prev"), F.col("_next")
    shape = (
        F.when(back.isNull() | ahead.isNull(), 0)
        .when((x > back) & (x > ahead), 1)
        .when((x < back) & (x < ahead), -1)
    )
    shaped = sliding(runs, inner, 1, 1, add).withColumn("_shape", shape)
    return shaped.filter(F.col("_shape").isNotNull()).select(
        *keys, "_pos", "_x", "_shape", "_mid"
    )


def _chunk_levels(turns: DataFrame, layout: Layout, peaks: float, valleys: float) -> DataFrame:
    """Per chunk, the level each side starts from: clamps of all other chunks, composed."""
    keys = list(layout.series.keys)
    key_fields = [turns.schema[k] for k in keys]
    ends = [T.StructField(f"{s}_{e}", T.DoubleType()) for s in SIDES for e in ("lo", "hi")]
    chunk_field = T.StructField("_chunk", T.LongType())

    def shorten(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("_pos")["_x"].to_numpy()
        line = {k: pdf[k].iloc[0] for k in (*keys, "_chunk")}
        for side, (values, p) in zip(SIDES, _sides(x, peaks, valleys)):
            line[f"{side}_lo"], line[f"{side}_hi"] = summary(values, p)
        return pd.DataFrame([line])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk").reset_index(drop=True)
        made = pdf[[*keys, "_chunk"]].copy()
        for side in SIDES:
            order = range(len(pdf)) if side.endswith("left") else reversed(range(len(pdf)))
            level, found = START, {}
            for i in order:
                found[i] = level
                level = min(max(level, pdf[f"{side}_lo"][i]), pdf[f"{side}_hi"][i])
            made[side] = [found[i] for i in range(len(pdf))]
        return made

    summed = turns.groupBy(*keys, "_chunk").applyInPandas(
        shorten, T.StructType([*key_fields, chunk_field, *ends])
    )
    starts = [T.StructField(s, T.DoubleType()) for s in SIDES]
    return summed.groupBy(*keys).applyInPandas(
        chain, T.StructType([*key_fields, chunk_field, *starts])
    )


def _prominent(turns: DataFrame, layout: Layout, peaks: float, valleys: float) -> DataFrame:
    """(keys, _at, _peak, _valley) for the rows in the middle of prominent runs."""
    keys = list(layout.series.keys)
    if layout.single:
        cut = turns.withColumns({"_chunk": F.lit(0).cast("long"), **{s: F.lit(START) for s in SIDES}})
    else:
        turns = session.stored(turns, "turns")
        inner = plan_layout(turns, Series(tuple(keys), "_pos", ()), layout.chunk_rows)
        numbered = session.stored(
            with_position(turns, inner, "_turn").withColumn(
                "_chunk", F.floor(F.col("_turn") / inner.chunk_rows).cast("long")
            ),
            "numbered-turns",
        )
        starts = _chunk_levels(numbered, layout, peaks, valleys)
        cut = attach(numbered, starts, (*keys, "_chunk"), inner.cell_count, inner.broadcast_rows)

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        x, shape = pdf["_x"].to_numpy(), pdf["_shape"].to_numpy()
        need = []
        for side, (values, p) in zip(SIDES, _sides(x, peaks, valleys)):
            found = levels(values, p, pdf[side].iloc[0])
            need.append(np.array(found if side.endswith("left") else found[::-1]))
        pdf["_peak"] = (shape == 1) & (x >= need[0]) & (x >= need[1])
        pdf["_valley"] = (shape == -1) & (-x >= need[2]) & (-x >= need[3])
        hits = pdf[pdf["_peak"] | pdf["_valley"]]
        return hits[[*keys, "_mid", "_peak", "_valley"]].rename(columns={"_mid": "_at"})

    result = T.StructType(
        [
            *[turns.schema[k] for k in keys], T.StructField("_at", T.LongType()),
            T.StructField("_peak", T.BooleanType()), T.StructField("_valley", T.BooleanType()),
        ]
    )
    wanted = cut.select(*keys, "_chunk", "_pos", "_x", "_shape", "_mid", *SIDES)
    return wanted.groupBy(*keys, "_chunk").applyInPandas(judge, result)


def peaks_and_valleys(
    df: DataFrame,
    column: str,
    prominence_peaks: float = 50,
    prominence_valleys: float = 50,
    series: Series = Series(),
) -> DataFrame:
    """Add `peak_anomaly` and `valley_anomaly` (0/1).

    A plateau counts once, at its middle row; the ends of a series are never peaks.
    """
    table, series, finish = for_python(df, series)
    keys = list(series.keys)
    there = table.filter(F.col(column).isNotNull())
    layout = plan_layout(there, series)
    placed = with_position(there, layout, "_pos").withColumn("_x", F.col(column).cast("double"))
    turns = _turns(placed.select(*keys, "_pos", "_x"), layout)
    hits = _prominent(turns, layout, float(prominence_peaks), float(prominence_valleys))
    joined = attach(
        placed.drop("_x"), hits.withColumnRenamed("_at", "_pos"), (*keys, "_pos"),
        layout.rows, layout.broadcast_rows,
    )
    none = F.lit(False)
    marked = joined.drop("_pos").unionByName(
        table.filter(F.col(column).isNull()).withColumns({"_peak": none, "_valley": none})
    )
    labelled = marked.withColumns(
        {
            "peak_anomaly": F.coalesce("_peak", none).cast("int"),
            "valley_anomaly": F.coalesce("_valley", none).cast("int"),
        }
    )
    return finish(labelled.drop("_peak", "_valley"))


def prominence(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
               series: Series = Series(), threshold: float = 50) -> DataFrame:
    """Flag rows that are peaks or valleys of at least the given prominence."""
    s = scoped(df, series, scope)
    flagged = s.df
    for c in columns:
        flagged = peaks_and_valleys(flagged, c, threshold, threshold, s.inner)
        hit = (F.col("peak_anomaly") + F.col("valley_anomaly")) > 0
        flagged = flagged.withColumn(f"{c}_flag", hit).drop("peak_anomaly", "valley_anomaly")
    return flagged
