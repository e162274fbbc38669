"""Planting synthetic anomalies with labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwarden.operators.series import Series, attach, plan_layout, sliding, with_position

# How far a planted value lies from its neighbours' mean, its rounding, and
# the volume above which a row counts as a volume anomaly.
PRICE_REACH = 0.00001 * 4.5
PRICE_DIGITS = 2
VOLUME_REACH = 0.1 * 3
VOLUME_DIGITS = 5
VOLUME_LABEL_ABOVE = 0.2


# Draws that one row of a series' sizes is spread into at a time.
DRAWS = 100_000


def hashed_draws(id_column: str = "uuid", seed: int = 42) -> Callable[[str], Column]:
    """Uniform numbers in [0, 1) from a row's id, one per purpose, the same in any run."""

    def draw(purpose: str) -> Column:
        bits = F.xxhash64(F.col(id_column), F.lit(purpose), F.lit(seed))
        return F.pmod(bits, F.lit(1 << 31)) / F.lit(float(1 << 31))

    return draw


def hashed_picks(keys: Sequence[str], seed: int = 42) -> Callable[[str, Column, Column], Column]:
    """The place in [0, n) that the k-th draw of a series names, the same in any run."""

    def pick(column: str, k: Column, n: Column) -> Column:
        return F.pmod(F.xxhash64(*keys, F.lit(column), k, F.lit(seed)), n)

    return pick


def drawn_places(df: DataFrame, ratio: float, series: Series, columns: Sequence[str],
                 pick: Callable[[str, Column, Column], Column]) -> DataFrame:
    """(keys, _place, _<column>_hit): the places that draws with replacement name, each once.

    A series of n rows has exactly max(1, int(ratio * n)) draws per column; one on its first or last
    row moves a row inwards.  Series of fewer than three rows have none.  The draws are rows of their own, made where
    they are needed, so a long series' draws are no single task's.
    """
    keys = list(series.keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 3")
    many = F.greatest(F.lit(1), F.floor(F.lit(ratio) * F.col("_n"))).cast("long")
    parts = sizes.withColumn("_many", many).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_many") - 1, F.lit(DRAWS).cast("long")))
    )
    parts = parts.repartition(*keys, "_from")
    k = F.explode(F.sequence("_from", F.least(F.col("_from") + (DRAWS - 1), F.col("_many") - 1)))
    draws = parts.withColumn("_k", k).withColumn("_column", F.explode(F.array(*[F.lit(c) for c in columns])))
    place = F.coalesce(*[F.when(F.col("_column") == c, pick(c, F.col("_k"), F.col("_n"))) for c in columns])
    inner = F.greatest(F.lit(1), F.least(place, F.col("_n") - 2)).cast("long")
    hits = [F.max(F.col("_column") == c).alias(f"_{c}_hit") for c in columns]
    return draws.withColumn("_place", inner).groupBy(*keys, "_place").agg(*hits)


def add_anomalies(
    df: DataFrame,
    ratio: float = 0.02,
    series: Series = Series(),
    draws: Callable[[str], Column] | None = None,
    picks: Callable[[str, Column, Column], Column] | None = None,
) -> DataFrame:
    """Replace the prices and the volumes of drawn rows and label them.

    Which rows: see `drawn_places`; a row drawn twice is replaced once.  A planted value is the mean of
    its original neighbours moved up or down by a random share of that mean.
    `volume_anomaly` finally marks every volume above the fixed level, planted or not.
    """
    draws, picks = draws or hashed_draws(), picks or hashed_picks(series.keys)
    layout = plan_layout(df, series)
    places = drawn_places(df, ratio, series, ("price", "volume"), picks)
    bound = 2 * int(ratio * layout.rows) + 2 * layout.groups
    placed = with_position(df, layout, "_place")
    placed = attach(placed, places, (*series.keys, "_place"), bound, layout.broadcast_rows)

    def planted(column: str, reach: float, digits: int, w: WindowSpec) -> Column:
        mean = (F.lag(column).over(w) + F.lead(column).over(w)) / 2
        sign = F.when(draws(f"{column}_sign") < 0.5, -1.0).otherwise(1.0)
        return F.round(mean + sign * (draws(f"{column}_size") * reach) * mean, digits)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns(
            {
                "_price_new": planted("price", PRICE_REACH, PRICE_DIGITS, w),
                "_volume_new": planted("volume", VOLUME_REACH, VOLUME_DIGITS, w),
            }
        )

    moved = sliding(placed, layout, 1, 1, add, "_place")
    hit = {c: F.coalesce(F.col(f"_{c}_hit"), F.lit(False)) for c in ("price", "volume")}
    volume = F.when(
        hit["volume"] & (F.col("_volume_new") > VOLUME_LABEL_ABOVE), F.col("_volume_new")
    ).otherwise(F.col("volume"))
    labelled = moved.withColumns(
        {
            "price": F.when(hit["price"], F.col("_price_new")).otherwise(F.col("price")),
            "volume": volume,
            "price_anomaly": hit["price"].cast("double"),
            "volume_anomaly": F.coalesce((volume > VOLUME_LABEL_ABOVE).cast("double"), F.lit(0.0)),
        }
    )
    return labelled.drop("_place", *[f"_{c}_{part}" for c in ("price", "volume") for part in ("new", "hit")])
