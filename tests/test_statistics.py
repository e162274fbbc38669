import math
import random
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwarden.functions.normal import normal_quantile, normal_upper
from tickwarden.operators import (
    clean,
    correlation,
    decompose,
    describe,
    evaluate,
    fill,
    inject,
    resample,
    stationarity,
)
from tickwarden.operators.scope import chosen_batch_size
from tickwarden.operators.series import Series

CHUNKS = pytest.mark.parametrize("chunk", [67, 1_000_000])
LINE = Series(("name",), "t", ())


@pytest.fixture(autouse=True)
def chunk_rows(request, spark):
    if "chunk" in request.fixturenames:
        spark.conf.set("spark.tickwarden.chunkRows", str(request.getfixturevalue("chunk")))
    yield
    spark.conf.unset("spark.tickwarden.chunkRows")


def line(spark, values, name="s"):
    frame = pd.DataFrame({"name": name, "t": range(len(values)), "x": values})
    return spark.createDataFrame(frame, "name string, t long, x double")


def noise(n, seed=0):
    return np.random.default_rng(seed).normal(0, 1, n)


def column(df, name, order="t"):
    return df.toPandas().sort_values(order)[name].to_numpy(dtype=float)


def test_normal_functions(spark):
    probs = [1e-12, 1e-5, 0.02, 0.3, 0.5, 0.77, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in probs], "p double").withColumn("z", normal_quantile(F.col("p")))
    for row in df.withColumn("up", normal_upper("z")).collect():
        assert abs(row.z - NormalDist().inv_cdf(row.p)) < 1e-8
        assert abs(row.up - (1 - row.p)) < 1e-9


def test_k2_is_small_for_normal_and_large_for_exponential(spark):
    p = describe.normality(line(spark, noise(2000)), "x").first().p
    assert p > 0.01
    assert describe.normality(line(spark, np.exp(noise(2000))), "x").first().p < 1e-6
    assert describe.normality(line(spark, noise(5)), "x").first().p is None
    assert describe.normality(line(spark, [2.0] * 20), "x").first().p is None


@CHUNKS
def test_shapiro(spark, chunk):
    normal = describe.shapiro(line(spark, noise(300)), "x", ["name"], ["t"]).first()
    skewed = describe.shapiro(line(spark, np.exp(noise(300))), "x", ["name"], ["t"]).first()
    assert normal.w > 0.98 and normal.p > 0.01 and skewed.p < 1e-6
    few = describe.shapiro(line(spark, noise(8, 3)), "x", ["name"], ["t"]).first()
    assert 0.7 < few.w <= 1 and 0 <= few.p <= 1
    assert describe.shapiro(line(spark, [1.0] * 30), "x", ["name"], ["t"]).first().w is None


def acf_of(x, k):
    c = x - x.mean()
    return (c[k:] * c[: len(c) - k]).sum() / (c * c).sum()


@CHUNKS
def test_acf_and_pacf(spark, chunk):
    x = np.convolve(noise(400), [1, 0.6, 0.3])
    got = correlation.acf(line(spark, x), "x", LINE, 12).toPandas().sort_values("lag")
    want = np.array([acf_of(x, k) for k in range(13)])
    np.testing.assert_allclose(got.acf, want, atol=1e-10)
    assert abs(got.band.iloc[1] - 1.96 / math.sqrt(len(x))) < 1e-12
    partial = correlation.pacf(line(spark, x), "x", LINE, 12).toPandas().sort_values("lag")
    for k in range(1, 13):
        toeplitz = [[want[abs(i - j)] for j in range(k)] for i in range(k)]
        assert abs(partial.pacf.iloc[k] - np.linalg.solve(toeplitz, want[1 : k + 1])[-1]) < 1e-9


def test_default_lags_follow_the_length(spark):
    got = correlation.acf(line(spark, noise(100)), "x", LINE)
    assert got.agg(F.max("lag")).first()[0] == 20
    assert correlation.acf(line(spark, noise(6)), "x", LINE).agg(F.max("lag")).first()[0] == 3


def brute_adf(x, max_lag):
    def fit(lags, start):
        y = np.diff(x)[start:]
        z = [np.ones(len(y)), x[start : start + len(y)]]
        z += [np.diff(x)[start - j : len(np.diff(x)) - j] for j in range(1, lags + 1)]
        z = np.column_stack(z)
        beta, *_ = np.linalg.lstsq(z, y, rcond=None)
        r = y - z @ beta
        ssr = r @ r
        se = math.sqrt(ssr / (len(y) - z.shape[1]) * np.linalg.inv(z.T @ z)[1, 1])
        n = len(y)
        return n * (math.log(2 * math.pi * ssr / n) + 1) + 2 * z.shape[1], beta[1] / se
    best = min(range(max_lag + 1), key=lambda k: fit(k, max_lag)[0])
    return best, fit(best, best)[1]


@CHUNKS
@pytest.mark.parametrize("kind", ["walk", "stationary"])
def test_adf_matches_least_squares(spark, chunk, kind):
    e = np.convolve(noise(300, 4), [1, 0.7, -0.4])
    x = (np.cumsum(e) if kind == "walk" else e) * 1000 + 50_000
    row = stationarity.adf(line(spark, x), "x", LINE).first()
    lag, statistic = brute_adf(x, stationarity.default_max_lag(len(x)))
    assert row.used_lag == lag and abs(row.statistic - statistic) < 1e-6
    assert row.stationary == (kind == "stationary")
    assert row.crit_1pct < row.crit_5pct < row.crit_10pct < 0


def test_adf_p_values():
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert abs(stationarity.p_value(tau) - p) < 0.002
    assert stationarity.p_value(5) == 1 and stationarity.p_value(-30) == 0


@CHUNKS
@pytest.mark.parametrize("model", ["additive", "multiplicative"])
@pytest.mark.parametrize("period", [6, 7])
def test_decomposition_recombines(spark, chunk, model, period):
    t = np.arange(200)
    x = 50 + 0.1 * t + 5 * np.sin(2 * np.pi * t / period) + noise(200)
    parts = decompose.decompose(line(spark, x), "x", period, model, LINE).toPandas().sort_values("t")
    half = period // 2
    assert parts.trend.isna().sum() == 2 * half
    inner = parts.dropna()
    if model == "additive":
        back, centre = inner.trend + inner.seasonal + inner.resid, 0
    else:
        back, centre = inner.trend * inner.seasonal * inner.resid, 1
    np.testing.assert_allclose(back, inner.observed, rtol=1e-12)
    assert abs(parts.seasonal[:period].mean() - centre) < 1e-9
    if period % 2:
        want = pd.Series(x).rolling(period, center=True).mean()
        np.testing.assert_allclose(parts.trend, want, rtol=1e-12)


@CHUNKS
def test_interpolation_matches_pandas(spark, chunk):
    r = random.Random(2)
    x = [None if i < 4 or i > 380 or r.random() < 0.4 or 100 < i < 300 else float(i % 17) for i in range(400)]
    got = column(fill.interpolate(line(spark, x), ("x",), LINE), "x")
    want = pd.Series(x, dtype=float).interpolate(method="linear").to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-12)


@CHUNKS
def test_rolling_and_changes_match_pandas(spark, chunk):
    x = pd.Series(noise(300))
    smooth = resample.rolling_mean(line(spark, x), ("x",), 3, LINE)
    np.testing.assert_allclose(column(smooth, "x_smooth"), x.rolling(3).mean(), atol=1e-12)
    moved = resample.changes(line(spark, x), ("x",), LINE)
    np.testing.assert_allclose(column(moved, "x_diff"), x.diff(), atol=1e-12)
    np.testing.assert_allclose(column(moved, "x_pct_change"), x.pct_change(), atol=1e-9)


def test_resample_matches_pandas(spark):
    r = random.Random(4)
    frame = pd.DataFrame(
        {"symbol": r.choices("ab", k=200), "s": [r.randrange(20_000) for _ in range(200)], "price": noise(200), "volume": noise(200) ** 2}
    )
    df = spark.createDataFrame(frame).withColumn("trade_ts", F.timestamp_seconds("s"))
    got = resample.resample(df, 1).toPandas().set_index(["symbol", "bucket"]).sort_index()
    frame["ts"] = pd.to_datetime(frame.s, unit="s")
    for symbol, part in frame.groupby("symbol"):
        want = part.set_index("ts").groupby(pd.Grouper(freq="s")).agg({"price": "mean", "volume": "sum"})
        np.testing.assert_allclose(got.loc[symbol].price, want.price, atol=1e-12)
        np.testing.assert_allclose(got.loc[symbol].volume, want.volume, atol=1e-12)


def test_histogram_closes_the_last_bin(spark):
    got = describe.histogram(line(spark, [0.0, 1.0, 2.0, 9.0, 10.0]), "x", 5).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 0, 2]
    flat = describe.histogram(line(spark, [3.0, 3.0]), "x", 4).collect()
    assert sum(r.n for r in flat) == 2


def test_minmax_of_a_constant_is_zero(spark):
    assert set(column(clean.minmax(line(spark, [4.0, 4.0]), ["x"]), "x_normalized")) == {0.0}


@CHUNKS
def test_injection_labels_and_keeps_neighbours(spark, chunk):
    frame = pd.DataFrame(
        {"symbol": "a", "uuid": [f"{i:04d}" for i in range(500)], "s": range(500), "price": 100 + noise(500), "volume": np.abs(noise(500))}
    )
    df = spark.createDataFrame(frame).withColumn("trade_ts", F.timestamp_seconds("s")).drop("s")
    got = inject.add_anomalies(df, 0.1).toPandas().sort_values("uuid").reset_index(drop=True)
    hit = got.price_anomaly == 1
    assert 20 < hit.sum() < 90 and not hit.iloc[0] and not hit.iloc[-1]
    assert (got.price[~hit] == frame.price[~hit]).all()
    mean = (frame.price.shift(1) + frame.price.shift(-1)) / 2
    assert ((got.price - mean).abs()[hit] <= mean[hit] * 0.000045 + 0.0051).all()
    assert ((got.volume > 0.2) == (got.volume_anomaly == 1)).all()
    one = inject.add_anomalies(df, 0.000001).agg(F.sum("price_anomaly")).first()[0]
    assert one >= 1


def test_metrics_by_hand(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 4 + [(None, None)]
    df = spark.createDataFrame(rows, "t int, p int")
    matrix = evaluate.confusion(df, "t", "p")
    assert matrix.first() == (5, 1, 2, 3)
    assert evaluate.confusion(df, "t", "p", swap=True).first() == (5, 2, 1, 3)
    m = evaluate.metrics(matrix).first()
    assert (m.accuracy, m.precision, m.recall) == (8 / 11, 0.75, 0.6) and abs(m.f1 - 2 / 3) < 1e-12
    empty = evaluate.metrics(evaluate.confusion(df.limit(0), "t", "p")).first()
    assert empty.precision == empty.recall == empty.f1 == 0


def test_zero_fill_and_batch_choice(spark):
    df = spark.createDataFrame([(1, None, None), (None, True, 4)], "a int, b boolean, batch_size int")
    assert fill.fill_with_zero(df).collect() == [(1, False, 0), (0, True, 4)]
    assert chosen_batch_size(fill.fill_with_zero(df)) == 2
    assert chosen_batch_size(df, 15) == 15
