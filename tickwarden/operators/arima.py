"""ARIMA(1,1,1) residual detector.

With w the first differences, residuals follow e[t] = w[t] - phi w[t-1] - theta e[t-1], and so do
their derivatives by phi and theta.  All three are affine in what they were just before a stretch
of rows.  A stretch is therefore summed up by five running numbers and the sums of their products,
and stretches compose: the sum of squares, its gradient and the Gauss-Newton matrix of a series of any length
come from its chunks' summaries.  Parameters follow by damped Gauss-Newton steps until these end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session
from tickwarden.functions.missing import number
from tickwarden.operators.scope import Scope, Scoped, scoped, whole
from tickwarden.operators.series import (
    Layout,
    Series,
    attach,
    for_python,
    plan_layout,
    sliding,
    with_position,
)

# Where the descent may begin: the best of these pairs.
STARTS = tuple((p / 10, t / 10) for p in range(-9, 10, 3) for t in range(-9, 10, 3))
EVALUATIONS = 60
# A descent has ended when a step would move less than this, or gains less than this share.
LEAST_MOVE, LEAST_GAIN = 1e-8, 1e-12
FIRST_DAMP, MOST_DAMP = 1e-3, 1e12
# Farthest place on the line that stands for (-1, 1); there a parameter is within 1e-14 of its bound.
FARTHEST = 1e7
LEAST_STEPS = 3
# Longest scope fitted as one array, many scopes at a time.
ARRAY_ROWS = 1000
# Chunks composed into one before the choice.
FOLD = 256
STATE = ("u", "v", "cost", "pp", "pt", "tt", "ep", "et", "damp", "next_u", "next_v", "evaluations", "ended")


# ---- stretches -----------------------------------------------------------------------------------


def stretch(w: np.ndarray, back: np.ndarray, phi: np.ndarray, theta: np.ndarray, entered: bool = True
            ) -> tuple[np.ndarray, np.ndarray]:
    """Running numbers after, and sums of products over, every column of `w` (steps x columns) for every candidate.

    With x, y, z the residual and its derivatives before the stretch, those within are e = m x + a,
    e' = m y + b and e" = m z + c x + d.  The numbers are (m, c, a, b, d), or just (a, b, d) where
    nothing came before.
    """
    shape = np.broadcast_shapes((w.shape[1], 1), phi.shape)
    m, c, a, b, d = np.ones(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape)
    size = 5 if entered else 3
    products = np.zeros((size, size, *shape))
    for t in range(w.shape[0]):
        step, prior = w[t, :, None], back[t, :, None]
        d = -a - theta * d
        b = -prior - theta * b
        a = step - phi * prior - theta * a
        if entered:
            c = -m - theta * c
            m = -theta * m
        now = np.stack([m, c, a, b, d][-size:])
        products += now[:, None] * now[None]
    return np.stack([m, c, a, b, d][-size:]), products


def then(first: tuple[np.ndarray, np.ndarray], later: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The summary of two stretches, one after the other."""
    (m, c, a, b, d), _ = first
    none, one = np.zeros_like(m), np.ones_like(m)
    turn = np.stack([
        np.stack([m, none, none, none, none]), np.stack([c, m, none, none, none]), np.stack([a, none, one, none, none]),
        np.stack([b, none, none, one, none]), np.stack([d, a, none, none, one]),
    ])
    moved = np.einsum("ij...,jk...->ik...", turn, later[1])
    return np.einsum("ij...,j...->i...", turn, later[0]), first[1] + np.einsum("ij...,kj...->ik...", moved, turn)


def long_stretch(w: np.ndarray, back: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summary of one long stretch per candidate, worked in parallel pieces of about sqrt(n) steps."""
    size = max(1, int(np.sqrt(len(w))))
    whole_part = len(w) - len(w) % size
    numbers, products = stretch(
        w[:whole_part].reshape(-1, size).T, back[:whole_part].reshape(-1, size).T, phi[None, :], theta[None, :]
    )
    parts = [(numbers[:, i], products[:, :, i]) for i in range(whole_part // size)]
    if whole_part < len(w):
        numbers, products = stretch(w[whole_part:, None], back[whole_part:, None], phi[None, :], theta[None, :])
        parts.append((numbers[:, 0], products[:, :, 0]))
    return reduce(then, parts)


def residuals(w: np.ndarray, back: np.ndarray, phi: float, theta: float, e: float) -> np.ndarray:
    """Residuals after the residual `e`: pieces of about sqrt(n) steps at once, each started by the one before."""
    size = max(1, int(np.sqrt(len(w))))
    drive = w - phi * back
    drive = np.concatenate([drive, np.zeros(-len(w) % size)]).reshape(-1, size)
    for t in range(1, size):
        drive[:, t] -= theta * drive[:, t - 1]
    powers = (-theta) ** np.arange(1, size + 1)
    enter = np.empty(len(drive))
    for i, last in enumerate(drive[:, -1]):
        enter[i] = e
        e = last + powers[-1] * e
    return (drive + powers * enter[:, None]).ravel()[: len(w)]


# ---- the descent ---------------------------------------------------------------------------------


def inside(u: np.ndarray) -> np.ndarray:
    """From the line to the open interval (-1, 1), where a series is stationary and invertible."""
    return u / np.sqrt(1 + u * u)


def begun(costs: np.ndarray) -> np.ndarray:
    """States (STATE x ...) that first look at the best of STARTS; `costs`: ... x STARTS."""
    at = np.asarray(STARTS)[np.argmin(costs, axis=-1)]
    state = np.zeros((len(STATE), *costs.shape[:-1]))
    line = at / np.sqrt(1 - at**2)
    begin = {"cost": np.inf, "damp": FIRST_DAMP, "next_u": line[..., 0], "next_v": line[..., 1]}
    for name, value in begin.items():
        state[STATE.index(name)] = value
    return state


def advance(state: np.ndarray, products: np.ndarray) -> np.ndarray:
    """The states after a look at (next_u, next_v); `products` of (a, b, d) there.

    A look that lowers the sum of squares becomes the place to go on from, with less damping; another raises
    the damping.  `ended`: 1 where no step is left worth taking, 2 where EVALUATIONS did not suffice.
    """
    s = dict(zip(STATE, state.copy()))
    going = s["ended"] == 0
    cost = products[0, 0]
    better = cost < s["cost"]
    with np.errstate(invalid="ignore"):
        settled = better & (s["cost"] - cost <= LEAST_GAIN * cost)
    new = {"u": s["next_u"], "v": s["next_v"], "cost": cost, "pp": products[1, 1], "pt": products[1, 2],
           "tt": products[2, 2], "ep": products[0, 1], "et": products[0, 2]}
    s |= {k: np.where(better, x, s[k]) for k, x in new.items()}
    s["damp"] = np.where(better, s["damp"] / 10, s["damp"] * 10)
    s["evaluations"] = s["evaluations"] + 1
    # derivatives by u and v
    du, dv = ((1 + s[k] ** 2) ** -1.5 for k in "uv")
    a, b, d = s["pp"] * du * du * (1 + s["damp"]), s["pt"] * du * dv, s["tt"] * dv * dv * (1 + s["damp"])
    g, h = s["ep"] * du, s["et"] * dv
    det = a * d - b * b
    det = np.where(det > 0, det, np.inf)
    s["next_u"] = np.clip(s["u"] - (d * g - b * h) / det, -FARTHEST, FARTHEST)
    s["next_v"] = np.clip(s["v"] - (a * h - b * g) / det, -FARTHEST, FARTHEST)
    move = np.maximum(*(np.abs(inside(s[f"next_{k}"]) - inside(s[k])) for k in "uv"))
    over = settled | (move < LEAST_MOVE) | (s["damp"] > MOST_DAMP)
    s["ended"] = np.where(over, 1.0, np.where(s["evaluations"] >= EVALUATIONS, 2.0, 0.0))
    return np.where(going, np.stack([s[k] for k in STATE]), state)


def parameters(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return inside(state[0]), inside(state[1])


def _looked_at(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = STATE.index("next_u")
    return inside(state[at]), inside(state[at + 1])


def fit_many(w: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Fit every column of `w` on its own: the states at the end."""
    phi, theta = (np.array([p]) for p in zip(*STARTS))
    costs = np.zeros((w.shape[1], len(STARTS)))
    a = np.zeros_like(costs)
    for t in range(w.shape[0]):
        a = w[t, :, None] - phi * back[t, :, None] - theta * a
        costs += a * a
    state = begun(costs)
    while (left := np.flatnonzero(state[-1] == 0)).size:
        phi, theta = _looked_at(state[:, left])
        _, products = stretch(w[:, left], back[:, left], phi[:, None], theta[:, None], entered=False)
        state[:, left] = advance(state[:, left], products[..., 0])
    return state


def fit_long(w: np.ndarray, back: np.ndarray) -> np.ndarray:
    """The same for one long series, by the composition that serves chunks."""
    phi, theta = (np.array(p) for p in zip(*STARTS))
    state = begun(long_stretch(w, back, phi, theta)[1][2, 2])
    while state[-1] == 0:
        phi, theta = (np.array([x]) for x in _looked_at(state))
        state = advance(state, long_stretch(w, back, phi, theta)[1][2:, 2:, 0])
    return state


def _flags_of_arrays(threshold: float, include_first: bool):
    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def judge(arrays: pd.Series) -> pd.Series:
        values = arrays.map(lambda v: np.asarray(v, dtype=float))
        there = values.map(lambda v: ~np.isnan(v))
        flags = there.map(lambda t: np.zeros(len(t), dtype=bool))
        sizes = there.map(np.count_nonzero)
        for size, index in sizes.groupby(sizes).groups.items():
            if size <= LEAST_STEPS:
                continue
            x = np.stack([values[i][there[i]] for i in index], axis=1)
            w = np.diff(x, axis=0)
            back = np.vstack([np.zeros(w.shape[1]), w[:-1]])
            phi, theta = parameters(fit_many(w, back))
            e = np.zeros_like(w)
            last = np.zeros(w.shape[1])
            for t in range(len(w)):
                last = w[t] - phi * back[t] - theta * last
                e[t] = last
            if include_first:
                e = np.vstack([x[0], e])
            hit = np.abs(e) > threshold * e.std(axis=0, ddof=1)
            if not include_first:
                hit = np.vstack([np.zeros(w.shape[1], dtype=bool), hit])
            for column, i in enumerate(index):
                flags[i][there[i]] = hit[:, column]
        return flags.map(np.ndarray.tolist)

    return judge


def _short_scopes(s: Scoped, columns: Sequence[str], threshold: float, include_first: bool
                  ) -> DataFrame:
    """Scopes of a bounded number of rows become arrays and are fitted many at a time."""
    judge = _flags_of_arrays(threshold, include_first)
    order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(s.series.order)]
    row = F.struct(*order, F.struct(*[F.col(c) for c in s.df.columns]).alias("row"))
    grouped = s.df.groupBy(*s.keys).agg(F.sort_array(F.collect_list(row)).alias("_rows"))

    def values_of(c: str) -> Column:
        return F.transform("_rows", lambda r: r["row"][c].cast("double"))

    values = {c: values_of(c) for c in columns}
    judged = grouped.withColumns({f"_f_{c}": judge(v) for c, v in values.items()})
    zipped = F.arrays_zip(
        F.transform("_rows", lambda r: r["row"]).alias("row"),
        *[F.col(f"_f_{c}") for c in columns],
    )
    flat = judged.select(F.explode(zipped).alias("z"))
    return flat.select("z.row.*", *[F.col("z")[f"_f_{c}"].alias(f"{c}_flag") for c in columns])


def _steps(df: DataFrame, layout: Layout, column: str) -> DataFrame:
    """(keys, order, _pos, _w, _back) for every row that has a difference.

    Rows without a value are passed over: the next difference is from the last value there was.
    """
    x = number(column)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        one, two = F.lag("_x", 1).over(w), F.lag("_x", 2).over(w)
        return d.withColumns(
            {"_w": F.col("_x") - one, "_back": F.coalesce(one - two, F.lit(0.0))}
        )

    slim = df.select(*dict.fromkeys((*layout.series.keys, *layout.series.order)), x.alias("_x"))
    placed = with_position(slim.filter("_x IS NOT NULL"), layout, "_pos")
    return sliding(placed, layout, 2, 0, add, "_pos").filter(F.col("_w").isNotNull())


def _key_fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in names]


def _fit_fields(steps: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([*_key_fields(steps, keys), T.StructField("_state", T.ArrayType(T.DoubleType())),
                         T.StructField("_steps", T.LongType())])


def _fits_at_once(steps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _state, _steps) of series that fit one task; no state where there are too few steps."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        state = None
        if len(pdf) >= LEAST_STEPS:
            state = fit_long(pdf["_w"].to_numpy(), pdf["_back"].to_numpy()).tolist()
        return pd.DataFrame([{k: pdf[k].iloc[0] for k in keys} | {"_state": state, "_steps": len(pdf)}])

    return steps.groupBy(*keys).applyInPandas(run, _fit_fields(steps, keys))


def _residuals_at_once(steps: DataFrame, keys: list[str], order: list[str],
                       fixed: tuple[float, float] | None) -> DataFrame:
    """Fit and residuals of series that fit one task."""
    kept = list(dict.fromkeys((*keys, *order)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        w, back = pdf["_w"].to_numpy(), pdf["_back"].to_numpy()
        if fixed is None and len(w) < LEAST_STEPS:
            pdf["_e"] = np.nan
        else:
            phi, theta = fixed or parameters(fit_long(w, back))
            pdf["_e"] = residuals(w, back, float(phi), float(theta), 0.0)
        return pdf[[*kept, "_e"]]

    out = T.StructType([*_key_fields(steps, kept), T.StructField("_e", T.DoubleType())])
    return steps.groupBy(*keys).applyInPandas(run, out)


def _packed(cut: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _chunk, _w, _back): a chunk's differences as bytes, so that later passes move nothing."""
    bytes_of = [T.StructField(c, T.BinaryType()) for c in ("_w", "_back")]
    out = T.StructType([*_key_fields(cut, [*keys, "_chunk"]), *bytes_of])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        line = {k: pdf[k].iloc[0] for k in (*keys, "_chunk")}
        return pd.DataFrame([line | {c: pdf[c].to_numpy(float).tobytes() for c in ("_w", "_back")}])

    slim = cut.select(*dict.fromkeys((*keys, "_chunk", "_pos", "_w", "_back")))
    return session.stored(slim.groupBy(*keys, "_chunk").applyInPandas(run, out), "arima-chunks")


def _summaries(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _chunk, _state, _steps, _numbers, _products) of each chunk at what its series looks at next.

    Without a state that is all of STARTS.
    """
    lists = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_state", "_numbers", "_products")]
    out = T.StructType([*_key_fields(chunks, [*keys, "_chunk"]), T.StructField("_steps", T.LongType()), *lists])

    def run(frames):
        for pdf in frames:
            made = []
            for _, row in pdf.iterrows():
                w, back = np.frombuffer(row["_w"]), np.frombuffer(row["_back"])
                if row["_state"] is None:
                    phi, theta = (np.array(p) for p in zip(*STARTS))
                else:
                    phi, theta = (np.array([x]) for x in _looked_at(np.asarray(row["_state"])))
                numbers, products = long_stretch(w, back, phi, theta)
                made.append({k: row[k] for k in (*keys, "_chunk")} | {
                    "_steps": len(w), "_state": row["_state"], "_numbers": numbers.ravel(), "_products": products.ravel()})
            yield pd.DataFrame(made, columns=out.names)

    return chunks.mapInPandas(run, out)


def _composed(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    shaped = ((n.reshape(5, -1), p.reshape(5, 5, -1)) for n, p in zip(map(np.asarray, pdf["_numbers"]), map(np.asarray, pdf["_products"])))
    return reduce(then, shaped)


def _folded(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Compose neighbouring chunks, so that few reach the step."""
    names = summaries.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        numbers, products = _composed(pdf)
        line = {k: pdf[k].iloc[0] for k in (*keys, "_chunk", "_state")}
        line |= {"_steps": int(pdf["_steps"].sum()), "_numbers": numbers.ravel(), "_products": products.ravel()}
        return pd.DataFrame([line], columns=names)

    near = F.floor(F.col("_chunk") / FOLD)
    return summaries.groupBy(*keys, near.alias("_near")).applyInPandas(run, summaries.schema)


def _stepped(summaries: DataFrame, keys: list[str], chunks: int) -> DataFrame:
    """(keys, _state, _steps): each series' state after a look; none has more than `chunks`."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        _, products = _composed(pdf)
        before, steps = pdf["_state"].iloc[0], int(pdf["_steps"].sum())
        if steps < LEAST_STEPS:
            state = None
        elif before is None:
            state = begun(products[2, 2]).tolist()
        else:
            state = advance(np.asarray(before, float), products[2:, 2:, 0]).tolist()
        return pd.DataFrame([{k: pdf[k].iloc[0] for k in keys} | {"_state": state, "_steps": steps}])

    folded = _folded(summaries, keys) if chunks > FOLD else summaries
    return folded.groupBy(*keys).applyInPandas(run, _fit_fields(summaries, keys))


def _fits_by_chunk(chunks: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    """(keys, _state, _steps) for series of any length: a pass over the chunks per look, of those not yet done."""
    none = F.lit(None).cast("array<double>")
    most = layout.largest // layout.chunk_rows + 1
    states = session.stored(_stepped(_summaries(chunks.withColumn("_state", none), keys), keys, most), "arima-states")
    done = []
    for _ in range(EVALUATIONS):
        going = F.element_at("_state", -1) == 0
        done.append(states.filter(~F.coalesce(going, F.lit(False))))
        left = states.filter(going)
        if left.isEmpty():
            break
        looking = layout.attach(chunks, left.select(*keys, "_state"), keys).filter("_state IS NOT NULL")
        # some numbers per series; stored, lest later looks repeat earlier ones
        states = session.stored(_stepped(_summaries(looking, keys), keys, most), "arima-states")
    else:
        done.append(states)
    return reduce(DataFrame.unionByName, done)


def _starts(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _chunk, _phi, _theta, _e_in): the residual each chunk starts from.

    Two numbers per chunk are read in chunk order.
    """
    ends = [T.StructField(c, T.DoubleType()) for c in ("_phi", "_theta", "_m", "_a")]
    out = T.StructType([*_key_fields(chunks, [*keys, "_chunk"]), *ends])

    def last(frames):
        for pdf in frames:
            made = []
            for _, row in pdf.iterrows():
                w, back = np.frombuffer(row["_w"]), np.frombuffer(row["_back"])
                a = residuals(w, back, row["_phi"], row["_theta"], 0.0)[-1]
                made.append({k: row[k] for k in (*keys, "_chunk", "_phi", "_theta")} | {"_m": (-row["_theta"]) ** len(w), "_a": a})
            yield pd.DataFrame(made, columns=out.names)

    added = [T.StructField(c, T.DoubleType()) for c in ("_phi", "_theta", "_e_in")]
    begin = T.StructType([*_key_fields(chunks, [*keys, "_chunk"]), *added])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        e, starts = 0.0, []
        for a, m in zip(pdf["_a"], pdf["_m"]):
            starts.append(e)
            e = a + m * e
        return pdf[[*keys, "_chunk", "_phi", "_theta"]].assign(_e_in=starts)

    return chunks.mapInPandas(last, out).groupBy(*keys).applyInPandas(run, begin)


def _cut(steps: DataFrame, kept: list[str], layout: Layout) -> DataFrame:
    chunk = F.floor(F.col("_pos") / layout.chunk_rows).cast("long")
    return session.stored(steps.select(*kept, "_pos", "_w", "_back", chunk.alias("_chunk")), "arima-steps")


def _with_parameters(fits: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _phi, _theta)."""
    inner = [F.element_at("_state", i + 1) / F.sqrt(1 + F.element_at("_state", i + 1) ** 2) for i in range(2)]
    return fits.select(*keys, inner[0].alias("_phi"), inner[1].alias("_theta"))


def _residuals_by_chunk(steps: DataFrame, keys: list[str], order: list[str], layout: Layout,
                        fixed: tuple[float, float] | None) -> DataFrame:
    """The same for series of any length."""
    kept = list(dict.fromkeys((*keys, *order)))
    cut = _cut(steps, kept, layout)
    chunks = _packed(cut, keys)
    if fixed:
        located = chunks.withColumns({"_phi": F.lit(float(fixed[0])), "_theta": F.lit(float(fixed[1]))})
    else:
        found = session.stored(_with_parameters(_fits_by_chunk(chunks, keys, layout), keys), "arima-fits")
        located = layout.attach(chunks, found, keys)
    starts = _starts(located, keys)
    cells = layout.groups * (layout.rows // layout.chunk_rows + 1)
    ready = attach(cut, starts, (*keys, "_chunk"), cells, layout.broadcast_rows)
    out = T.StructType([*_key_fields(cut, kept), T.StructField("_e", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        first = pdf.iloc[0]
        pdf["_e"] = residuals(pdf["_w"].to_numpy(), pdf["_back"].to_numpy(), first["_phi"], first["_theta"], first["_e_in"])
        return pdf[[*kept, "_e"]]

    return ready.groupBy(*keys, "_chunk").applyInPandas(run, out)


def arima_fit(df: DataFrame, column: str, scope: Scope = whole(), series: Series = Series()) -> DataFrame:
    """(scope keys, phi, theta, squares, steps, evaluations, converged): what `arima` goes by, a row per scope.

    squares: the sum of squared residuals.  converged is false where the descent used up EVALUATIONS looks, and
    where there are fewer than LEAST_STEPS differences, which also leaves the rest NULL.
    """
    s = scoped(df, series, scope)
    table, inner, finish = for_python(s.df, s.inner)
    layout = plan_layout(table, inner, session.python_rows(df.sparkSession))
    keys, steps = list(inner.keys), _steps(table, layout, column)
    if layout.single:
        fits = _fits_at_once(steps, keys)
    else:
        fits = _fits_by_chunk(_packed(_cut(steps, keys, layout), keys), keys, layout)
    at = {name: F.element_at("_state", i + 1) for i, name in enumerate(STATE)}
    phi, theta = (at[k] / F.sqrt(1 + at[k] ** 2) for k in "uv")
    return finish(fits.select(
        *keys, phi.alias("phi"), theta.alias("theta"), at["cost"].alias("squares"), F.col("_steps").alias("steps"),
        at["evaluations"].cast("int").alias("evaluations"), F.coalesce(at["ended"] == 1, F.lit(False)).alias("converged"),
    ))


def arima_residuals(df: DataFrame, column: str, series: Series = Series(),
                    fixed: tuple[float, float] | None = None, layout: Layout | None = None
                    ) -> DataFrame:
    """(keys, order columns, residual) from the second value of each series on.

    `fixed` gives (phi, theta) instead of fitting them.  Rows whose value is NULL or NaN are passed over.
    """
    layout = layout or plan_layout(df, series, session.python_rows(df.sparkSession))
    steps = _steps(df, layout, column)
    keys, order = list(series.keys), list(series.order)
    made = (
        _residuals_at_once(steps, keys, order, fixed)
        if layout.single
        else _residuals_by_chunk(steps, keys, order, layout, fixed)
    )
    known = F.when(~F.isnan("_e"), F.col("_e"))
    return made.withColumn("residual", known).drop("_e")


def arima(df: DataFrame, columns: Sequence[str], scope: Scope = whole(),
          series: Series = Series(), threshold: float = 3.0, include_first: bool = False
          ) -> DataFrame:
    """Flag rows whose residual exceeds `threshold` sample deviations of the residuals.

    A scope too short to fit flags nothing, and neither does a row without a value, which the
    residuals of later rows pass over.  The first row has no difference; with
    `include_first` its residual is its own value, which nearly always flags it.
    """
    s = scoped(df, series, scope)
    if s.bounded and s.limit <= ARRAY_ROWS:
        return _short_scopes(s, columns, threshold, include_first)
    table, inner, finish = for_python(s.df, s.inner)
    layout = plan_layout(table, inner, session.python_rows(df.sparkSession))
    judged = Scoped(table, inner, inner.keys, counted=layout.counted)
    for c in columns:
        found = arima_residuals(table, c, inner, layout=layout)
        if not layout.single:  # the spread and every later column would work them out again
            found = session.stored(found, "arima-residuals")
        on = list(dict.fromkeys((*inner.keys, *inner.order)))
        rows = attach(judged.df, found, on, layout.rows, layout.broadcast_rows)
        if include_first:
            rows = rows.withColumn("residual", F.coalesce("residual", F.col(c).cast("double")))
        spread = rows.groupBy(*inner.keys).agg(F.stddev_samp("residual").alias("_std"))
        hit = F.abs("residual") > threshold * F.col("_std")
        judged = replace(judged, df=rows).attach(spread).with_columns(
            {f"{c}_flag": F.coalesce(hit, F.lit(False))}
        )
        judged = replace(judged, df=judged.df.drop("residual", "_std"))
    return finish(judged.df)
