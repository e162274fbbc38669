"""Isolation forest on one value column.

On one dimension a tree is a step function of the value: its splits cut the line and each
piece has a path length.  A forest is the sum of its trees' steps, so a scope's whole model
is one sorted list of splits with the mean path length between them (at most
trees x (sample - 1) splits), and scoring is one lookup per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session
from tickwarden.operators.quantiles import quantiles
from tickwarden.operators.scope import Scope, Scoped, scoped, whole
from tickwarden.operators.series import Series, attach, for_python, plan_layout

# Fixed values of the published method: trees and rows per tree, and Euler's constant.
TREES, SAMPLE = 100, 256
EULER = 0.5772156649
BITS = 1 << 30
# Trees grown in one call; a call holds this many samples.
TREES_PER_TASK = 20
# Bytes of all scopes' models that may go to every task.
MODEL_BYTES = 64_000_000


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def grow(values: np.ndarray, rng: np.random.Generator) -> tuple[list[float], list[float]]:
    """Splits in order and the path length of each piece between them."""
    values = np.sort(values)
    deepest = math.ceil(math.log2(max(len(values), 2)))
    splits: list[float] = []
    paths: list[float] = []
    stack: list = [(0, len(values), 0)]
    while stack:
        top = stack.pop()
        if not isinstance(top, tuple):
            splits.append(top)
            continue
        lo, hi, depth = top
        if hi - lo <= 1 or depth >= deepest or values[lo] == values[hi - 1]:
            paths.append(depth + average_path(hi - lo))
            continue
        cut = rng.uniform(values[lo], values[hi - 1])
        middle = int(np.searchsorted(values[lo:hi], cut, side="right")) + lo
        middle = min(max(middle, lo + 1), hi - 1)
        # in-order walk: the right part is pushed first so that the left is read first
        stack += [(middle, hi, depth + 1), float(cut), (lo, middle, depth + 1)]
    return splits, paths


def merge(trees: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One step function: all splits in order, and the mean path length of each piece."""
    splits = np.unique(np.concatenate([s for s, _ in trees]))
    inside = np.append(splits, np.inf)  # a value on a split belongs to the piece below it
    total = np.zeros(len(inside))
    for cuts, paths in trees:
        total += np.asarray(paths)[np.searchsorted(cuts, inside, side="left")]
    return splits, total / len(trees)


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BITS)) / F.lit(float(BITS))


def _tree_numbers(ids: Sequence[str], seed: int, trees: int, sample: int) -> Column:
    """The trees a row may be drawn for, given its scope's size `_n`.

    About twice the needed rows are let through.  A row makes as many draws as the trees it
    should reach on average (one in a large scope); each names a tree or none.  In a scope
    so small that every tree may see all of it, each row goes to every tree.
    """
    key = [F.col(c) for c in ids]
    share = 2.0 * sample / F.col("_n")
    draws = F.ceil(trees * share).cast("int")
    picked = F.transform(
        F.sequence(F.lit(0), draws - 1),
        lambda i: F.floor(_uniform(*key, F.lit(seed), i) * draws / share).cast("int"),
    )
    some = F.array_distinct(F.filter(picked, lambda t: t < trees))
    return F.when(share >= 1.0, F.sequence(F.lit(0), F.lit(trees - 1))).otherwise(some)


def forests(rows: DataFrame, keys: list[str], ids: Sequence[str], column: str, seed: int,
            trees: int, sample: int) -> DataFrame:
    """(keys, splits, scores) per scope; `rows` carries the scope size `_n`."""
    drawn = rows.withColumn("_tree", F.explode(_tree_numbers(ids, seed, trees, sample)))
    place = Window.partitionBy(*keys, "_tree").orderBy(
        F.xxhash64(*[F.col(c) for c in ids], F.lit(seed + 2), F.col("_tree")), *ids
    )
    samples = drawn.withColumn("_rank", F.row_number().over(place)).filter(
        F.col("_rank") <= sample
    )
    fields = [rows.schema[k] for k in keys]
    doubles = T.ArrayType(T.DoubleType())
    tree_type = T.StructType(
        [
            *fields, T.StructField("_size", T.IntegerType()), T.StructField("_tree", T.IntegerType()),
            T.StructField("_splits", doubles), T.StructField("_paths", doubles),
        ]
    )

    def some_trees(pdf: pd.DataFrame) -> pd.DataFrame:
        shared = {k: pdf[k].iloc[0] for k in keys}
        lines = []
        for tree, part in pdf.sort_values("_rank").groupby("_tree"):
            rng = np.random.default_rng([seed, int(tree), len(part)])
            splits, paths = grow(part["_x"].to_numpy(), rng)
            made = {"_size": len(part), "_tree": tree, "_splits": splits, "_paths": paths}
            lines.append(shared | made)
        return pd.DataFrame(lines)

    grown = samples.select(*keys, "_tree", "_rank", F.col(column).cast("double").alias("_x"))
    stand = F.floor(F.col("_tree") / TREES_PER_TASK)
    grown = grown.groupBy(*keys, stand.alias("_stand")).applyInPandas(some_trees, tree_type)
    forest_type = T.StructType(
        [*fields, T.StructField("_splits", doubles), T.StructField("_scores", doubles)]
    )

    def one_forest(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [
            (np.asarray(s, dtype=float), np.asarray(p, dtype=float))
            for s, p in zip(pdf["_splits"], pdf["_paths"])
        ]
        splits, path = merge(parts)
        usual = average_path(float(pdf["_size"].max()))
        score = np.exp2(-path / usual) if usual > 0 else np.full(len(path), 0.5)
        line = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([line | {"_splits": splits, "_scores": score}])

    return grown.groupBy(*keys).applyInPandas(one_forest, forest_type)


def scored(s: Scoped, columns: Sequence[str], ids: Sequence[str], chunk_rows: int, seed: int = 42,
           trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """The rows with `_score_<column>`: above 0.5 means isolated early, NULL has no score.

    Where the models of all scopes are small together, by a bound from their number, they go to the tasks and rows
    stay where they are.  Else a scope's rows are dealt into as many parts as its size needs and its model is repeated
    for each, so a hot scope is scored by many tasks.
    """
    keys = list(s.keys)
    s = s.count()
    counts = [F.count(c).alias(f"_n_{c}") for c in columns]
    sizes = s.df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
    sized = s.attach(sizes).df
    few = s.counted[1] + 1  # as many models as scopes; left to the join's own size check
    models = sizes
    for c in columns:
        rows = sized.filter(F.col(c).isNotNull()).select(*keys, *ids, c, F.col(f"_n_{c}").alias("_n"))
        model = forests(rows, keys, ids, c, seed, trees, sample).withColumnsRenamed(
            {"_splits": f"_splits_{c}", "_scores": f"_scores_{c}"}
        )
        models = attach(models, model, keys, few, 0)
    if s.counted[1] * len(columns) * trees * sample * 16 <= MODEL_BYTES:
        return _scored_in_place(s, models, columns)
    parts = F.ceil(F.col("_n") / chunk_rows).cast("int")
    dealt = sized.withColumn(
        "_part", F.pmod(F.xxhash64(*[F.col(c) for c in ids]), parts).cast("int")
    ).select(*s.df.columns, "_part")
    model_columns = [f"_{part}_{c}" for part in ("splits", "scores") for c in columns]
    spread = models.select(
        *[F.col(k).alias(k) for k in keys],  # new columns, as both sides come from one table
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
        *model_columns,
    )
    group, names = [*keys, "_part"], list(s.df.columns)
    made = [f"_score_{c}" for c in columns]
    out = T.StructType([*s.df.schema.fields, *[T.StructField(m, T.DoubleType()) for m in made]])

    def look_up(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        for c in columns:
            splits = model[f"_splits_{c}"].iloc[0]
            if splits is None:
                rows[f"_score_{c}"] = np.nan
                continue
            x = rows[c].to_numpy(dtype=float)
            scores = np.asarray(model[f"_scores_{c}"].iloc[0])
            at = np.searchsorted(splits, x, side="left").clip(max=len(scores) - 1)
            rows[f"_score_{c}"] = np.where(np.isnan(x), np.nan, scores[at])
        return rows[[*names, *made]]

    both = dealt.groupBy(*group).cogroup(spread.groupBy(*group)).applyInPandas(look_up, out)
    return both.withColumns({m: F.when(~F.isnan(m), F.col(m)) for m in made})


def _scored_in_place(s: Scoped, models: DataFrame, columns: Sequence[str]) -> DataFrame:
    keys = list(s.keys)
    # one row per scope, at most MODEL_BYTES
    found = models.select(*keys, *[f"_{part}_{c}" for c in columns for part in ("splits", "scores")]).collect()
    steps = {
        c: [tuple(np.asarray(r[f"_{part}_{c}"]) if r[f"_{part}_{c}"] is not None else None for part in ("splits", "scores")) for r in found]
        for c in columns
    }
    fields = [*[models.schema[k] for k in keys], T.StructField("_scope", T.IntegerType())]
    numbers = models.sparkSession.createDataFrame([(*[r[k] for k in keys], i) for i, r in enumerate(found)], T.StructType(fields))
    placed, made = s.attach(numbers).df, [f"_score_{c}" for c in columns]
    out = T.StructType([*s.df.schema.fields, *[T.StructField(m, T.DoubleType()) for m in made]])

    def look_up(frames):
        for rows in frames:
            scope = rows["_scope"].to_numpy()
            for c in columns:
                x = rows[c].to_numpy(dtype=float)
                score = np.full(len(rows), np.nan)
                for at in np.unique(scope):
                    splits, scores = steps[c][int(at)]
                    if splits is not None:
                        own = (scope == at) & ~np.isnan(x)
                        score[own] = scores[np.searchsorted(splits, x[own], side="left").clip(max=len(scores) - 1)]
                rows[f"_score_{c}"] = score
            yield rows[out.names]

    scored_rows = placed.mapInPandas(look_up, out)
    return scored_rows.withColumns({m: F.when(~F.isnan(m), F.col(m)) for m in made})


def iforest(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
            series: Series = Series(), contamination: float = 0.05, seed: int = 42,
            trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """Flag the share `contamination` of each scope that a seeded forest isolates soonest.

    Rows are identified by the series' tie-breakers, which must be unique.
    """
    s = scoped(df, series, scope)
    table, inner, finish = for_python(s.df, s.inner)
    current = Scoped(table, inner, inner.keys).count()
    layout = plan_layout(table, inner, known=current.counted)
    share = [1.0 - contamination]
    marked = scored(current, columns, series.ties, min(layout.chunk_rows, session.PYTHON_ROWS), seed, trees, sample)
    if not layout.single:  # several passes for the quantiles
        marked = session.stored(marked, "forest-scores")
    if layout.single:
        over = Window.partitionBy(*inner.keys)
        judged = marked.withColumns(
            {f"_cut_{c}": F.percentile(f"_score_{c}", share).over(over) for c in columns}
        )
    else:
        wanted = {f"_cut_{c}": f"_score_{c}" for c in columns}
        cuts = quantiles(marked, inner.keys, wanted, share, known=current.counted)
        judged = Scoped(marked, inner, inner.keys, counted=current.counted).attach(cuts).df
    flags = {
        f"{c}_flag": F.coalesce(F.col(f"_score_{c}") > F.col(f"_cut_{c}")[0], F.lit(False))
        for c in columns
    }
    helpers = [f"_{part}_{c}" for part in ("score", "cut") for c in columns]
    return finish(judged.withColumns(flags).drop(*helpers))
