"""Statistics over trailing time windows in linear time.

A RANGE frame is summed again for every row, which is quadratic in the rows per window.
Here time is cut into cells no longer than the window, so a row's window is the tail of an
earlier cell, all cells between, and the head of its own.  Heads and tails are running sums.
Where every series fits a task the cells are the multiples of the window length, and nothing
lies between.  In a large table they are also cut at the bounds of its time slices, and at
these bounds a window length earlier; then no cell holds more than a slice of rows, and no
more than a slice of rows ask for tails of one cell.  What lies between comes from a sparse
table: summaries of 1, 2, 4, ... consecutive cells near the bounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.operators.series import Layout, Series, attach, buckets, plan_layout

MICROS = 1_000_000
PIECE = ("n", "m", "q", "lo", "hi")


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _pieces(df: DataFrame, columns: Sequence[str], layout: Layout, peers: bool) -> tuple[DataFrame, bool]:
    """Rows as (count, mean, squares, low, high) per column.

    When one instant holds more rows than a task should, and all of them are in each other's windows, the rows of
    every instant are first folded into one (map-side); the second result tells.
    """
    keys, time = layout.series.keys, layout.series.time
    x = {c: F.col(c).cast("double") for c in columns}
    if layout.heavy and peers:
        parts = []
        for c in columns:
            n = F.count(x[c])
            parts += [
                n.cast("double").alias(f"_n_{c}"),
                F.coalesce(F.avg(x[c]), F.lit(0.0)).alias(f"_m_{c}"),
                F.coalesce(F.var_pop(x[c]) * n, F.lit(0.0)).alias(f"_q_{c}"),
                F.min(x[c]).alias(f"_lo_{c}"),
                F.max(x[c]).alias(f"_hi_{c}"),
            ]
        return df.groupBy(*keys, time).agg(*parts), True
    made = {}
    for c in columns:
        made[f"_n_{c}"] = F.when(x[c].isNull(), 0.0).otherwise(1.0)
        made[f"_m_{c}"] = F.coalesce(x[c], F.lit(0.0))
        made[f"_q_{c}"] = F.lit(0.0)
        made[f"_lo_{c}"] = x[c]
        made[f"_hi_{c}"] = x[c]
    return df.withColumns(made), False


def _helpers(columns: Sequence[str]) -> list[str]:
    return [f"_{k}_{c}" for k in PIECE for c in columns]


# ---- summaries: struct<n, mean, q, lo, hi>, q being the squared distances from the mean ---------


def _summary(c: str, level: Column, side: Column, fold) -> Column:
    """The summary of those pieces of a column where `side` holds; `fold` turns an aggregate into what is wanted.

    Sums are taken around `level`, so subtracting squares loses nothing.
    """
    n, d = F.col(f"_n_{c}"), F.col(f"_m_{c}") - level

    def total(value: Column) -> Column:
        return F.coalesce(fold(F.sum(F.when(side, value))), F.lit(0.0))

    count, s, ss = total(n), total(n * d), total(F.col(f"_q_{c}") + n * d * d)
    return F.struct(
        count.alias("n"),
        s.alias("s"),
        ss.alias("ss"),
        fold(F.min(F.when(side, F.col(f"_lo_{c}")))).alias("lo"),
        fold(F.max(F.when(side, F.col(f"_hi_{c}")))).alias("hi"),
    )


def _settled(name: str, level: Column) -> Column:
    """From sums around `level` to mean and squares."""
    x = F.col(name)
    away = F.try_divide(x["s"], x["n"])
    return F.struct(
        x["n"].alias("n"),
        (level + away).alias("mean"),
        F.greatest(x["ss"] - x["s"] * away, F.lit(0.0)).alias("q"),
        x["lo"].alias("lo"),
        x["hi"].alias("hi"),
    )


def _both(a: Column, b: Column) -> Column:
    """The summary of two disjoint sets; NULL stands for none."""
    none = [F.coalesce(x["n"], F.lit(0.0)) == 0 for x in (a, b)]
    n, d = a["n"] + b["n"], b["mean"] - a["mean"]
    joined = F.struct(
        n.alias("n"),
        (a["mean"] + d * b["n"] / n).alias("mean"),
        (a["q"] + b["q"] + d * d * a["n"] * b["n"] / n).alias("q"),
        F.least(a["lo"], b["lo"]).alias("lo"),
        F.greatest(a["hi"], b["hi"]).alias("hi"),
    )
    return F.when(none[0], b).when(none[1], a).otherwise(joined)


def _folded(summaries: Column) -> Column:
    """The summary of an array of disjoint ones."""
    nothing = F.expr("CAST(NULL AS STRUCT<n: DOUBLE, mean: DOUBLE, q: DOUBLE, lo: DOUBLE, hi: DOUBLE>)")
    return F.aggregate(summaries, nothing, _both)


def _all_of(*parts: Column) -> Column:
    """The same of some columns; each is worked out once, however often the formula names it."""
    return _folded(F.array(*parts))


def _running(df: DataFrame, columns: Sequence[str], name: str, cell: Sequence[str], side: Column,
             over: WindowSpec) -> DataFrame:
    """Add `<name><column>`: the summary of the rows of `side` that `over` has reached."""
    whole = Window.partitionBy(*cell)
    df = df.withColumns(
        {f"_c_{c}": F.coalesce(F.avg(F.when(side, F.col(f"_m_{c}"))).over(whole), F.lit(0.0)) for c in columns}
    )
    sums = {f"{name}{c}": _summary(c, F.col(f"_c_{c}"), side, lambda a: a.over(over)) for c in columns}
    df = df.withColumns(sums)
    return df.withColumns({f"{name}{c}": _settled(f"{name}{c}", F.col(f"_c_{c}")) for c in columns}).drop(
        *[f"_c_{c}" for c in columns]
    )


def _ahead(cell: Sequence[str], ties: Sequence[str]) -> WindowSpec:
    """Up to a row: with all others of its instant, or in the order of `ties`."""
    over = Window.partitionBy(*cell).orderBy("_t", *ties)
    return (over.rowsBetween if ties else over.rangeBetween)(Window.unboundedPreceding, 0)


# ---- series that fit a task ----------------------------------------------------------------------


def _near_stats(pieces: DataFrame, columns: Sequence[str], layout: Layout, lengths: Sequence[int],
                ties: Sequence[str]) -> DataFrame:
    """`_all_<column>` where a series fits a task: each row once in its cell, once in the next, one shuffle."""
    t, w = F.col("_t"), F.col("_w")
    rows = pieces.withColumn("_t", _micros(layout.series.time)).select(
        "*", F.posexplode(F.array(*[F.lit(x).cast("long") for x in lengths])).alias("window_no", "_w")
    )
    pivot = F.floor(t / w).cast("long") * w
    cells = F.array(
        F.struct(pivot.alias("_pivot"), F.lit(True).alias("_own")),
        F.struct((pivot + w).alias("_pivot"), F.lit(False).alias("_own")),
    )
    copies = rows.withColumn("_cell", F.explode(cells)).select("*", "_cell.*").drop("_cell")
    cell, own = [*layout.series.keys, "window_no", "_pivot"], F.col("_own")
    copies = copies.withColumn("_reach", F.when(own, t - w).otherwise(t))
    back = Window.partitionBy(*cell).orderBy(F.desc("_reach"), "_own").rowsBetween(Window.unboundedPreceding, 0)
    summed = _running(copies, columns, "_tail_", cell, ~own, back)
    summed = _running(summed, columns, "_head_", cell, own, _ahead(cell, ties)).filter(own)
    both = {f"_all_{c}": _both(F.col(f"_tail_{c}"), F.col(f"_head_{c}")) for c in columns}
    done = [f"_{k}_{c}" for k in ("tail", "head") for c in columns]
    return summed.withColumns(both).drop("_w", "_pivot", "_own", "_reach", *done, *_helpers(columns))


# ---- series cut into slices ----------------------------------------------------------------------


def slice_bounds(layout: Layout, length: int) -> list[float]:
    """The slices' bounds, and these one window earlier."""
    return sorted({*layout.splits, *(b - length for b in layout.splits)})


def placed(pieces: DataFrame, layout: Layout, lengths: Sequence[int]) -> DataFrame:
    """Each row once per window length, with its cell (_f, _g) and the slice _q where its window begins.

    _f: fine slice; _g: whole window lengths since the epoch; the window begins at _g - 1.
    _near: a bound lies within a window length of the row's stretch between two multiples.
    """
    t = F.col("_t")
    rows = pieces.withColumn("_t", _micros(layout.series.time))
    places, each = {}, []
    for i, length in enumerate(lengths):
        bounds, turn = slice_bounds(layout, length), F.floor(t / length).cast("long")
        for name, at in (("f", t), ("q", t - length), ("a", (turn - 1) * length), ("b", (turn + 2) * length)):
            places[f"_{name}{i}"] = (at.cast("double"), bounds)
        each.append(
            F.struct(
                F.lit(i).alias("window_no"),
                F.lit(length).cast("long").alias("_w"),
                F.col(f"_f{i}").alias("_f"),
                F.col(f"_q{i}").alias("_q"),
                turn.alias("_g"),
                (F.col(f"_a{i}") < F.col(f"_b{i}")).alias("_near"),
            )
        )
    cut = buckets(rows, places).withColumn("_place", F.explode(F.array(*each)))
    return cut.select("*", "_place.*").drop("_place", *places)


def _cells_near(rows: DataFrame, columns: Sequence[str], cell: Sequence[str], many: int, layout: Layout) -> DataFrame:
    """The summaries of the cells near bounds, two map-side aggregates over slim columns."""
    near = rows.filter("_near").select(*cell, *_helpers(columns))
    levels = near.groupBy(*cell).agg(*[F.avg(f"_m_{c}").alias(f"_c_{c}") for c in columns])
    near = attach(near, levels, cell, many, layout.broadcast_rows)
    sums = [_summary(c, F.col(f"_c_{c}"), F.lit(True), lambda a: a).alias(f"_s_{c}") for c in columns]
    table = near.groupBy(*cell, *[f"_c_{c}" for c in columns]).agg(*sums)
    return table.select(*cell, *[_settled(f"_s_{c}", F.col(f"_c_{c}")).alias(f"_s_{c}") for c in columns])


def _between(rows: DataFrame, columns: Sequence[str], layout: Layout, lengths: Sequence[int]) -> tuple[DataFrame, int]:
    """(keys, window_no, _f, _g, _own_f, _mid_<column>): what lies between a window's first cell and its last.

    The number of cells near bounds grows with the slices and not with the rows, and so do
    the pairs of first and last cells.  A range of cells is a run of summaries of 1, 2, 4, ... cells.
    Also returns a bound on the rows.
    """
    keys = [*layout.series.keys, "window_no"]
    longest = max(4 * len(slice_bounds(layout, w)) + 4 for w in lengths)
    many = min(layout.rows * len(lengths), layout.groups * len(lengths) * longest)
    powers = longest.bit_length()
    cells = _cells_near(rows, columns, [*keys, "_f", "_g"], many, layout)
    order = Window.partitionBy(*keys).orderBy("_f", "_g")
    cells = cells.withColumn("_pos", F.row_number().over(order).cast("long"))

    runs = cells.withColumns({f"_l_{c}": F.array(f"_s_{c}") for c in columns})
    for k in range(powers - 1):
        runs = runs.withColumns({f"_x_{c}": F.lead(f"_s_{c}", 1 << k).over(order) for c in columns})
        runs = runs.withColumns({f"_s_{c}": _both(F.col(f"_s_{c}"), F.col(f"_x_{c}")) for c in columns})
        runs = runs.withColumns({f"_l_{c}": F.concat(f"_l_{c}", F.array(f"_s_{c}")) for c in columns})
    zipped = F.arrays_zip(*[F.col(f"_l_{c}") for c in columns])
    runs = runs.select(*keys, "_pos", F.posexplode(zipped).alias("_k", "_z")).select(
        *keys, "_pos", "_k", *[F.col("_z")[f"_l_{c}"].alias(f"_s_{c}") for c in columns]
    )

    pairs = rows.filter("_q < _f").select(
        *keys, F.col("_q").alias("_f"), (F.col("_g") - 1).alias("_g"), F.col("_f").alias("_own_f")
    ).distinct()
    # the first cell may hold no rows; the one after it follows the last cell at or before it
    mixed = cells.select(*keys, "_f", "_g", "_pos").unionByName(pairs, allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy("_f", "_g", F.asc_nulls_first("_own_f")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    pairs = mixed.withColumn("_low", F.coalesce(F.max("_pos").over(so_far), F.lit(0)) + 1)
    pairs = pairs.filter("_own_f IS NOT NULL").drop("_pos")
    last = cells.select(*keys, F.col("_f").alias("_own_f"), F.col("_g").alias("_own_g"), F.col("_pos").alias("_high"))
    pairs = attach(pairs.withColumn("_own_g", F.col("_g") + 1), last, [*keys, "_own_f", "_own_g"], many, layout.broadcast_rows)
    pair = [*keys, "_f", "_g", "_own_f"]
    bits = F.expr(
        f"filter(transform(sequence(0, {powers - 1}), k -> struct(k AS _k, shiftright(_high - _low, k) & 1 AS _some,"
        " _low + shiftleft(shiftright(_high - _low, k + 1), k + 1) AS _pos)), b -> b._some = 1)"
    )
    parts = pairs.filter("_high > _low").select(*pair, F.explode(bits).alias("_b")).select(*pair, "_b._k", "_b._pos")
    parts = attach(parts, runs, [*keys, "_pos", "_k"], many * powers, layout.broadcast_rows)

    return parts.groupBy(*pair).agg(*[_folded(F.collect_list(f"_s_{c}")).alias(f"_mid_{c}") for c in columns]), many


def _dealt(df: DataFrame, cell: Sequence[str], rows: int) -> DataFrame:
    """By cell, in as many tasks as `rows` need, so that what a task sorts does not grow with the table."""
    tasks = math.ceil(rows / session.SORTED_ROWS)
    usual = session.int_conf(df.sparkSession, "spark.sql.shuffle.partitions", 200)
    return df.repartition(tasks, *cell) if tasks > usual else df


def _sliced_stats(pieces: DataFrame, columns: Sequence[str], layout: Layout, lengths: Sequence[int],
                  ties: Sequence[str]) -> DataFrame:
    """`_all_<column>` where a series is cut: a row sums its head in its own cell and then asks for its tail.

    It lies in two cells, with all its columns in the one it asks and with its few numbers in its own.
    """
    keys = [*layout.series.keys, "window_no"]
    cell = [*keys, "_f", "_g"]
    rows = placed(pieces, layout, lengths)
    many = layout.rows * len(lengths)
    headed = _running(_dealt(rows, cell, many), columns, "_head_", cell, F.lit(True), _ahead(cell, ties))
    asking = headed.drop(*_helpers(columns)).withColumns(
        {"_own_f": F.col("_f"), "_f": F.col("_q"), "_g": F.col("_g") - 1, "_at": F.col("_t") - F.col("_w"), "_asks": F.lit(True)}
    )
    asked = rows.select(*cell, *_helpers(columns), F.col("_t").alias("_at"), F.lit(False).alias("_asks"))
    both = asked.unionByName(asking, allowMissingColumns=True)
    back = Window.partitionBy(*cell).orderBy(F.desc("_at"), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    tailed = _running(_dealt(both, cell, 2 * many), columns, "_tail_", cell, ~F.col("_asks"), back).filter("_asks")
    middle, many = _between(rows, columns, layout, lengths)
    whole = attach(tailed, middle, [*cell, "_own_f"], many, layout.broadcast_rows)
    whole = whole.withColumns(
        {f"_all_{c}": _all_of(*[F.col(f"_{k}_{c}") for k in ("tail", "mid", "head")]) for c in columns}
    )
    done = [f"_{k}_{c}" for k in ("tail", "mid", "head") for c in columns]
    return whole.drop("_w", "_f", "_q", "_g", "_near", "_own_f", "_at", "_asks", *done, *_helpers(columns))


def trailing_stats(pieces: DataFrame, columns: Sequence[str], layout: Layout,
                   windows: Sequence[float], peers: bool = True) -> DataFrame:
    """Add `_mean_<column>` and `_std_<column>` over the closed window ending at each row.

    Rows without a time have neither.
    """
    lengths = [int(w * MICROS) for w in windows]
    stats = (_sliced_stats if layout.splits else _near_stats)(
        pieces, columns, layout, lengths, () if peers else layout.series.ties
    )
    result = {}
    for c in columns:
        x = F.col(f"_all_{c}")
        timed = F.col("_t").isNotNull()
        spread = F.when((x["n"] > 1) & (x["lo"] < x["hi"]), F.sqrt(x["q"] / (x["n"] - 1)))
        result[f"_mean_{c}"] = F.when(timed & (x["n"] > 0), x["mean"])
        result[f"_std_{c}"] = F.when(timed, spread)
    return stats.withColumns(result).drop("_t", *[f"_all_{c}" for c in columns])


def trailing_scores(df: DataFrame, columns: Sequence[str], windows: Sequence[float],
                    series: Series = Series(), peers: bool = True) -> DataFrame:
    """Each row once per window length: `window_no` and the scores `<column>_z`.

    A score is the distance from the mean of the last so many seconds, in sample deviations.
    Both ends of the window are closed.  Rows at one instant see each other; without `peers` a row sees only those before
    it in the order of the series' ties, as a window that moves row by row does.  Then all rows of an instant meet in one
    task, in order, so an instant should not hold most of a table.
    """
    layout = plan_layout(df, series)
    pieces, folded = _pieces(df, columns, layout, peers)
    stats = trailing_stats(pieces, columns, layout, windows, peers)
    if folded:
        on = (*series.keys, series.time)
        stats = attach(df, stats, on, layout.rows, layout.broadcast_rows)
    scores = {
        f"{c}_z": F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))
        for c in columns
    }
    helpers = [f"_{k}_{c}" for k in ("mean", "std") for c in columns]
    return stats.withColumns(scores).drop(*helpers)
