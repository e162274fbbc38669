"""Ordered work on series of any length.

A series is all rows with the same keys, read in (time, ties) order.  One series
may hold most of the table, so nothing here windows over a whole series unless the
whole table fits one task.  Beyond that the rows are cut into *cells*: consecutive
slices of the time axis taken at approximate quantiles, so their sizes follow the
data and not the clock.  A time value that alone fills slices is cut again along the
tie-breakers.  Order-dependent operators work inside cells and take what they need
from earlier cells out of a small per-cell summary.
"""

from __future__ import annotations

import math
from collections import Counter, OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden import session

# Boundaries are held on the driver and inside one expression, so their number is bounded.
MAX_CHUNKS = 16384
LAST_SUB = 2**31 - 1


@dataclass(frozen=True)
class Series:
    """Which rows form a series and how they are ordered; `ties` makes the order total."""

    keys: tuple[str, ...] = ("symbol",)
    time: str = "trade_ts"
    ties: tuple[str, ...] = ("uuid",)

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.ties)


def buckets(df: DataFrame, places: dict[str, tuple[Column, Sequence[float]]]) -> DataFrame:
    """Add the number of bounds at or below each given double expression; NULL lies below all."""
    raw = {f"_raw{name}": F.coalesce(c, F.lit(-math.inf)) for name, (c, _) in places.items()}
    cut = Bucketizer(
        splitsArray=[[-math.inf, *bounds, math.inf] for _, bounds in places.values()],
        inputCols=list(raw),
        outputCols=[f"_cut{n}" for n in raw],
    ).transform(df.withColumns(raw))
    cut = cut.withColumns({name: F.col(f"_cut_raw{name}").cast("int") for name in places})
    return cut.drop(*raw, *[f"_cut{n}" for n in raw])


def sort_key(df: DataFrame, name: str) -> Column:
    """The order column as a double that sorts the same way (microseconds for times)."""
    dtype = df.schema[name].dataType
    column = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        column = F.unix_micros(column.cast("timestamp"))
    elif isinstance(dtype, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(dtype, T.DateType):
        column = F.unix_date(column)
    elif not isinstance(dtype, T.NumericType):
        raise TypeError(f"{name}: series need a time or numeric order column, not {dtype}")
    return column.cast("double")


@dataclass(frozen=True)
class Layout:
    """What one pass over the key columns told us about a series table."""

    series: Series
    rows: int
    groups: int
    largest: int
    chunk_rows: int
    broadcast_rows: int
    splits: tuple[float, ...] = ()
    heavy: dict[float, int] = field(default_factory=dict)

    @property
    def single(self) -> bool:
        """True when every series fits one task, so plain windows are safe."""
        return self.largest <= self.chunk_rows

    @property
    def counted(self) -> tuple[int, int, int]:
        return self.rows, self.groups, self.largest

    @property
    def cell_keys(self) -> tuple[str, ...]:
        return self.series.keys if self.single else (*self.series.keys, "_chunk", "_sub")

    @property
    def cell_count(self) -> int:
        if self.single:
            return self.groups
        per_series = len(self.splits) + 1 + 8 * sum(self.heavy.values())
        return min(self.rows, self.groups * per_series)

    @property
    def window(self) -> WindowSpec:
        """Rows of one cell in order."""
        return Window.partitionBy(*self.cell_keys).orderBy(*self.series.order)

    def chunk(self, df: DataFrame, columns: dict[str, Column]) -> DataFrame:
        """Add the time slice of each given double expression."""
        if not self.splits:
            return df.withColumns({name: F.lit(0) for name in columns})
        return buckets(df, {name: (c, self.splits) for name, c in columns.items()})

    def cells(self, df: DataFrame) -> DataFrame:
        """Add `_chunk` and `_sub`; (keys, _chunk, _sub) groups are bounded and ordered.

        Without tie-breakers equal times cannot be cut, so such series need distinct times.
        """
        if self.single:
            return df
        ordered = self.chunk(df, {"_chunk": sort_key(df, self.series.time)})
        if not self.heavy or not self.series.ties:
            return ordered.withColumn("_sub", F.lit(LAST_SUB))
        key, ties = sort_key(df, self.series.time), F.struct(*self.series.ties)
        # Every (chunk_rows / 4)-th row by hash marks a cut, so a heavy time value of k
        # chunks gets about 4k cuts.  collect_set folds copies map-side; the table stays
        # within a small multiple of MAX_CHUNKS entries and is safe to broadcast.
        step = max(1, self.chunk_rows // 4)
        marks = (
            df.filter(key.isin([float(v) for v in self.heavy]))
            .filter(F.pmod(F.xxhash64(*self.series.ties), F.lit(step)) == 0)
            .groupBy(key.alias("_heavy"))
            .agg(F.sort_array(F.collect_set(ties)).alias("_marks"))
        )
        isolated = F.when(
            key.isin([float(v) for v in self.heavy]),
            F.coalesce(F.size(F.filter("_marks", lambda m: m <= ties)), F.lit(0)),
        ).otherwise(F.lit(LAST_SUB))
        return (
            ordered.withColumn("_key", key)
            .join(F.broadcast(marks), F.col("_key") == F.col("_heavy"), "left")
            .withColumn("_sub", isolated)
            .drop("_key", "_heavy", "_marks")
        )

    def prior_cells(self) -> WindowSpec:
        """Cells of the same series in order; at most a few times MAX_CHUNKS rows each."""
        return Window.partitionBy(*self.series.keys).orderBy("_chunk", "_sub")

    def attach(self, df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
        rows = self.cell_count if tuple(keys) == self.cell_keys else self.groups
        return attach(df, summary, keys, rows, self.broadcast_rows)


def for_python(
    df: DataFrame, series: Series
) -> tuple[DataFrame, Series, Callable[[DataFrame], DataFrame]]:
    """Prepare a table for grouped Python functions.

    A series without keys gets a constant one.  Times become microseconds, as pandas would
    hold them in session local time, where an hour repeats once a year in many zones.
    Returns the table, the series, and what undoes both on the result.
    """
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    table = df.withColumns({c: F.unix_micros(c) for c in times}) if times else df
    if not series.keys:
        table = table.withColumn("_all", F.lit(0))
        series = Series(("_all",), series.time, series.ties)

    def finish(result: DataFrame) -> DataFrame:
        back = {c: F.timestamp_micros(c) for c in times if c in result.columns}
        return (result.withColumns(back) if back else result).drop("_all")

    return table, series, finish


class _Facts:
    """What was found out about a table, for the next operator that asks of the same plan.

    Facts only choose between ways to the same result, so one that a changed file has made stale costs time and nothing else.
    """

    def __init__(self, most: int = 256):
        self.most, self.found = most, OrderedDict()

    def get(self, about: DataFrame, *question, work: Callable[[], object]):
        key = (about.sparkSession.sparkContext.applicationId, about.semanticHash(), *question)
        known = self.found.get(key)
        if known is None or not known[0].sameSemantics(about):
            self.found[key] = known = (about, work())
            while len(self.found) > self.most:
                self.found.popitem(last=False)
        self.found.move_to_end(key)
        return known[1]


_FACTS = _Facts()


def count_groups(df: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """(rows, distinct keys, rows of the largest key), counted map-side over the key columns, once for the same table."""
    about = df.select(*[F.col(k) for k in keys]) if keys else df

    def count() -> tuple[int, int, int]:
        if not keys:
            rows = df.count()
            return rows, 1, rows
        sizes = about.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        found = sizes.agg(F.sum("_n"), F.count(F.lit(1)), F.max("_n")).first()
        return found[0] or 0, max(1, found[1]), found[2] or 0

    return _FACTS.get(about, "groups", tuple(keys), work=count)


def plan_layout(
    df: DataFrame,
    series: Series,
    chunk_rows: int | None = None,
    known: tuple[int, int, int] | None = None,
) -> Layout:
    """One pass over the key columns (unless `known` has its result), and one over the time
    column when some series does not fit one task; none for a table looked at before."""
    spark = df.sparkSession
    size = chunk_rows or session.int_conf(spark, session.CHUNK_ROWS, session.DEFAULT_CHUNK_ROWS)
    small = session.int_conf(spark, session.BROADCAST_ROWS, session.DEFAULT_BROADCAST_ROWS)
    rows, groups, largest = known or count_groups(df, series.keys)
    facts = dict(series=series, rows=rows, groups=groups, largest=largest, chunk_rows=size,
                 broadcast_rows=small)
    if largest <= size:
        return Layout(**facts)
    parts = min(MAX_CHUNKS, math.ceil(rows / size))
    points = [i / parts for i in range(1, parts)]
    times = df.select(sort_key(df, series.time).alias("_time"))
    cuts = _FACTS.get(
        times, "cuts", parts,
        work=lambda: times.agg(F.percentile_approx("_time", points, 8 * parts).alias("cuts")).first()["cuts"],
    )
    seen = Counter(cuts or [])
    heavy = {value: times for value, times in seen.items() if times > 1}
    return Layout(**facts, splits=tuple(sorted(seen)), heavy=heavy)


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, by scalar subquery."""
    row = totals.select(F.struct(*totals.columns).alias("_row")).scalar()
    return df.withColumn("_totals", row).select(
        *df.columns, *[F.col("_totals")[c].alias(c) for c in totals.columns]
    )


def attach(
    df: DataFrame, summary: DataFrame, keys: Sequence[str], rows: int, broadcast_rows: int
) -> DataFrame:
    """Left join of a per-group summary; NULL keys match.

    `rows` is the number of groups found by a count.  Within `broadcast_rows` the
    summary is broadcast and `df` does not move.  Beyond it the join shuffles and
    adaptive execution splits skewed keys.
    """
    fits = rows <= broadcast_rows
    if not keys:
        return with_totals(df, summary)
    renamed = summary.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_on_{k}"))
        condition = same if condition is None else condition & same
    right = F.broadcast(renamed) if fits else renamed
    return df.join(right, condition, "left").drop(*[f"_on_{k}" for k in keys])


def with_position(df: DataFrame, layout: Layout, name: str = "pos") -> DataFrame:
    """Add the 0-based place of each row in its series."""
    local = layout.cells(df).withColumn(name, F.row_number().over(layout.window) - 1)
    if layout.single:
        return local.withColumn(name, F.col(name).cast("long"))
    columns = list(dict.fromkeys((*layout.series.keys, *layout.series.order)))
    before = layout.prior_cells().rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        layout.cells(df.select(*columns))
        .groupBy(*layout.cell_keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    placed = layout.attach(local, offsets, layout.cell_keys)
    return placed.withColumn(name, (F.col(name) + F.col("_offset")).cast("long")).drop(
        "_offset", "_chunk", "_sub"
    )


def blocks(
    df: DataFrame, layout: Layout, before: int, after: int, pos: str = "pos"
) -> tuple[DataFrame, tuple[str, ...]]:
    """Group rows by position into equal blocks that overlap by the rows a frame can reach.

    Rows near a block's edge are copied to the neighbour, so each block can be worked on
    alone; originals are those with `_home` = `_block`.  Adds the position column if it is
    missing.  Returns the copies and their grouping keys.
    """
    placed = df if pos in df.columns else with_position(df, layout, pos)
    if layout.single:
        return placed.withColumns({"_home": F.lit(0), "_block": F.lit(0)}), (
            *layout.series.keys,
            "_block",
        )
    size = max(layout.chunk_rows, before, after)
    offset = F.col(pos) % size
    targets = F.array_compact(
        F.array(
            F.col("_home"),
            F.when((offset < after) & (F.col("_home") > 0), F.col("_home") - 1),
            F.when(offset >= size - before, F.col("_home") + 1),
        )
    )
    copied = placed.withColumn("_home", F.floor(F.col(pos) / size)).withColumn(
        "_block", F.explode(targets)
    )
    return copied, (*layout.series.keys, "_block")


def sliding(
    df: DataFrame,
    layout: Layout,
    before: int,
    after: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    pos: str | None = None,
) -> DataFrame:
    """Run `add(df, window)` whose frames reach `before` rows back and `after` ahead.

    `pos` names an existing position column.
    """
    if layout.single:
        order = [pos] if pos else list(layout.series.order)
        return add(df, Window.partitionBy(*layout.series.keys).orderBy(*order))
    place = pos or "_sliding_place"
    copied, keys = blocks(df, layout, before, after, place)
    window = Window.partitionBy(*keys).orderBy(place)
    kept = add(copied, window).filter(F.col("_home") == F.col("_block"))
    return kept.drop("_home", "_block", *([] if pos else [place]))
