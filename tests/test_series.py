import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwarden.operators.quantiles import quantiles
from tickwarden.operators.series import Series, plan_layout, sliding, with_position

S = Series(("symbol",), "t", ("uuid",))


def table(spark, n=1500, hot_time=0.0, seed=1):
    """One symbol holds most rows; `hot_time` is the share of rows at one instant."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = 500 if r.random() < hot_time else r.randrange(100_000)
        rows.append((r.choice(["a"] * 7 + ["b", "c", None]), t, f"{i:05d}", r.choice([0.0, 1.5, r.gauss(0, 1)])))
    r.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, t long, uuid string, x double")


@pytest.mark.parametrize("hot_time", [0.0, 0.4])
@pytest.mark.parametrize("size", [60, 10_000])
def test_position_is_exact_for_any_chunk_size(spark, hot_time, size):
    df = table(spark, hot_time=hot_time)
    layout = plan_layout(df, S, size)
    got = with_position(df, layout).toPandas()
    want = df.toPandas().sort_values(["t", "uuid"])
    want["pos"] = want.groupby("symbol", dropna=False).cumcount()
    merged = got.merge(want, on="uuid")
    assert len(merged) == len(want)
    assert (merged["pos_x"] == merged["pos_y"]).all()


def test_cells_stay_small_when_one_instant_is_hot(spark):
    df = table(spark, n=4000, hot_time=0.5)
    layout = plan_layout(df, S, 200)
    assert layout.heavy
    largest = layout.cells(df).groupBy(*layout.cell_keys).count().agg(F.max("count")).first()[0]
    assert largest < 800


@pytest.mark.parametrize("size", [40, 10_000])
def test_sliding_sees_neighbours_across_blocks(spark, size):
    df = table(spark)
    layout = plan_layout(df, S, size)
    got = sliding(
        df, layout, 3, 2,
        lambda d, w: d.withColumns({"back": F.lag("x", 3).over(w), "ahead": F.lead("x", 2).over(w)}),
    ).toPandas().set_index("uuid").sort_index()
    want = df.toPandas().sort_values(["t", "uuid"])
    groups = want.groupby("symbol", dropna=False)["x"]
    want["back"], want["ahead"] = groups.shift(3), groups.shift(-2)
    want = want.set_index("uuid").sort_index()
    pd.testing.assert_series_equal(got["back"], want["back"])
    pd.testing.assert_series_equal(got["ahead"], want["ahead"])


@pytest.mark.parametrize("size", [50, 10_000])
@pytest.mark.parametrize("keys", [("symbol",), ()])
def test_quantiles_match_pandas(spark, size, keys):
    df = table(spark)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles(df, keys, {"q": "x"}, probs, chunk_rows=size).collect()
    frame = df.toPandas()
    for row in got:
        part = frame
        if keys:
            part = frame[frame.symbol.isna()] if row.symbol is None else frame[frame.symbol == row.symbol]
        np.testing.assert_allclose(row.q, np.quantile(part.x, probs), rtol=0, atol=1e-12)
    assert len(got) == (4 if keys else 1)


@pytest.mark.parametrize("size", [50, 10_000])
def test_discrete_quantile(spark, size):
    df = table(spark)
    got = {r.symbol: r.q[0] for r in quantiles(df, ["symbol"], {"q": "x"}, [0.5], discrete=True, chunk_rows=size).collect()}
    frame = df.toPandas()
    for symbol, value in got.items():
        part = frame[frame.symbol.isna()] if symbol is None else frame[frame.symbol == symbol]
        ordered = sorted(part.x)
        assert value == ordered[int(np.ceil(0.5 * len(ordered))) - 1]
