import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickwarden import by_columns, detect, rows, time_window, whole
from tickwarden.operators import arima, iforest, peaks
from tickwarden.operators.detectors import DETECTORS, sweep, trailing_scores

BOTH = pytest.mark.parametrize("chunk", [61, 1_000_000])


def trades(spark, n=600, seed=3, ties=0.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        second = 5 if r.random() < ties else r.randrange(40_000)
        price = r.gauss(100, 3) + (40 if r.random() < 0.02 else 0)
        volume = None if r.random() < 0.05 else float(r.randrange(10))
        out.append((f"{i:04d}", r.choice("aaab"), price, volume, second))
    r.shuffle(out)
    table = spark.createDataFrame(out, "uuid string, symbol string, price double, volume double, s long")
    return table.withColumn("trade_ts", F.timestamp_seconds("s")).drop("s")


def ordered(df):
    return df.toPandas().sort_values(["symbol", "trade_ts", "uuid"]).reset_index(drop=True)


def flags(df, column="price"):
    return dict(df.select("uuid", f"{column}_flag").collect())


@pytest.fixture(autouse=True)
def chunk_rows(request, spark):
    if "chunk" in request.fixturenames:
        spark.conf.set("spark.tickwarden.chunkRows", str(request.getfixturevalue("chunk")))
    yield
    spark.conf.unset("spark.tickwarden.chunkRows")


def z_of(s):
    return ((s - s.mean()) / s.std()).abs() > 3


def iqr_of(s):
    a, b = s.quantile(0.25), s.quantile(0.75)
    return (s < a - 1.5 * (b - a)) | (s > b + 1.5 * (b - a))


@BOTH
@pytest.mark.parametrize("method,judge", [("zscore", z_of), ("iqr", iqr_of)])
@pytest.mark.parametrize("scope", ["whole", "rows"])
def test_zscore_and_iqr_match_pandas(spark, chunk, method, judge, scope):
    df = trades(spark)
    frame = ordered(df)
    keys = [frame.symbol]
    if scope == "rows":
        keys.append(frame.groupby("symbol").cumcount() // 20)
    got = detect(df, method, scope=whole() if scope == "whole" else rows(20))
    for column in ("price", "volume"):
        want = frame.groupby(keys)[column].transform(judge).fillna(False).astype(bool)
        assert flags(got, column) == dict(zip(frame.uuid, want))


@BOTH
def test_mad_uses_the_price_median_for_every_column(spark, chunk):
    df = trades(spark)
    frame = ordered(df)
    got = detect(df, "mad", threshold=4)

    def low(s):
        v = np.sort(s.dropna())
        return v[int(np.ceil(len(v) / 2)) - 1]

    for column in ("price", "volume"):
        want = {}
        for _, part in frame.groupby("symbol"):
            away = (part[column] - low(part.price)).abs()
            want |= dict(zip(part.uuid, (away / low(away) > 4).fillna(False)))
        assert flags(got, column) == want


@BOTH
def test_neighbour_rule(spark, chunk):
    df = trades(spark)
    frame = ordered(df)
    back, ahead = frame.groupby("symbol").price.shift(1), frame.groupby("symbol").price.shift(-1)
    x, edge = frame.price, back.isna() | ahead.isna()
    peak = (x > back) & (x > ahead) & (x - np.minimum(back, ahead) > 5)
    valley = (x < back) & (x < ahead) & (np.maximum(back, ahead) - x > 5)
    want = (peak | valley) & ~edge
    assert flags(detect(df, "neighbour", threshold=5)) == dict(zip(frame.uuid, want))


@BOTH
@pytest.mark.parametrize("ties", [0.0, 0.5])
def test_trailing_scores_match_brute_force(spark, chunk, ties):
    df = trades(spark, 300, ties=ties)
    got = {
        (r.uuid, r.window_no): r.price_z
        for r in trailing_scores(df, ["price"], [60, 3600]).collect()
    }
    frame = ordered(df)
    at = frame.trade_ts.astype("int64") // 10**9
    assert len(got) == 2 * len(frame)
    for i, row in frame.iterrows():
        for no, w in enumerate((60, 3600)):
            seen = frame[(frame.symbol == row.symbol) & (at >= at[i] - w) & (at <= at[i])].price
            want = (row.price - seen.mean()) / seen.std() if len(seen) > 1 else None
            z = got[row.uuid, no]
            assert (z is None) == (want is None)
            assert want is None or abs(z - want) < 1e-8


def test_constant_windows_never_score(spark):
    df = trades(spark, 200).withColumn("price", F.lit(0.1))
    assert trailing_scores(df, ["price"], [3600]).filter("price_z is not null").count() == 0


def test_sweep_counts_each_setting(spark):
    table = {r.window_seconds: r for r in sweep(trades(spark), ["price"], [(600, 1.0), (3600, 1.5)]).collect()}
    assert set(table) == {600.0, 3600.0}
    assert all(0 <= r.price_pct <= 100 for r in table.values())


def prominent(x, p):
    """Middles of the runs that are local maxima with prominence of at least p."""
    found, i = set(), 0
    while i < len(x):
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if i > 0 and j + 1 < len(x) and x[i - 1] < x[i] > x[j + 1]:
            def low(path):
                least = x[i]
                for v in path:
                    if v > x[i]:
                        break
                    least = min(least, v)
                return least
            if max(low(x[:i][::-1]), low(x[j + 1 :])) + p <= x[i]:
                found.add((i + j) // 2)
        i = j + 1
    return found


@BOTH
@pytest.mark.parametrize("seed", [1, 2])
def test_prominence_matches_brute_force(spark, chunk, seed):
    r = np.random.default_rng(seed)
    x = np.round(np.cumsum(r.integers(-2, 3, 500))).astype(float)
    df = spark.createDataFrame(
        pd.DataFrame({"symbol": "a", "trade_ts": np.arange(len(x)), "uuid": [f"{i:04d}" for i in range(len(x))], "x": x})
    )
    got = peaks.peaks_and_valleys(df, "x", 4, 3).toPandas().sort_values("trade_ts")
    assert set(np.flatnonzero(got.peak_anomaly)) == prominent(x.tolist(), 4)
    assert set(np.flatnonzero(got.valley_anomaly)) == prominent((-x).tolist(), 3)
    assert len(got) == len(x)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(-5, 5), max_size=40), st.integers(0, 40), st.integers(1, 5))
def test_clamps_compose(values, cut, p):
    """Going through two stretches equals going through one."""
    whole_run = peaks.levels(values + [0], p, peaks.START)
    first, second = values[:cut], values[cut:]
    low, high = peaks.summary(first, p)
    level = min(max(peaks.START, low), high) if first else peaks.START
    assert peaks.levels(second + [0], p, level) == whole_run[len(first) :]


@settings(deadline=None, max_examples=50)
@given(st.lists(st.floats(-10, 10), min_size=2, max_size=60), st.floats(-0.9, 0.9), st.floats(-0.9, 0.9))
def test_stretch_terms_give_the_residual_sum(steps, phi, theta):
    w = np.array(steps)
    back = np.append(0.0, w[:-1])
    (m, _, a, _, _), products = arima.long_stretch(w, back, np.array([phi]), np.array([theta]))
    e = arima.residuals(w, back, phi, theta, 0.0)
    assert np.isclose(products[2, 2, 0], (e**2).sum()) and np.isclose(a[0], e[-1])
    later = arima.residuals(w, back, phi, theta, 2.0)
    assert np.isclose(products[2, 2, 0] + 4 * products[0, 2, 0] + 4 * products[0, 0, 0], (later**2).sum())
    assert np.isclose(a[0] + 2 * m[0], later[-1])


def simulated(n, phi, theta, seed=5):
    e = np.random.default_rng(seed).normal(0, 1, n)
    w = np.zeros(n)
    for t in range(1, n):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    return w


def test_fit_recovers_parameters():
    w = simulated(5000, 0.5, 0.3)
    phi, theta = arima.parameters(arima.fit_long(w, np.append(0.0, w[:-1])))
    assert abs(phi - 0.5) < 0.05 and abs(theta - 0.3) < 0.06


def walk(spark, n=400, spikes=(150, 301)):
    x = np.cumsum(simulated(n, 0.4, 0.2))
    for i in spikes:
        x[i] += 25
    return spark.createDataFrame(
        pd.DataFrame({"symbol": "a", "trade_ts": np.arange(n), "uuid": [f"{i:04d}" for i in range(n)], "price": x})
    )


def test_arima_flags_spikes_the_same_for_any_chunk_size(spark):
    found = {}
    for size in ("73", "1000000"):
        spark.conf.set("spark.tickwarden.chunkRows", size)
        found[size] = {u for u, f in flags(detect(walk(spark), "arima", ("price",))).items() if f}
    assert found["73"] == found["1000000"] >= {"0150", "0301"}


def test_arima_first_row_only_on_request(spark):
    df = walk(spark).withColumn("price", F.col("price") + 1000)
    assert not flags(detect(df, "arima", ("price",)))["0000"]
    assert flags(detect(df, "arima", ("price",), include_first=True))["0000"]
    assert flags(detect(df, "arima", ("price",), rows(40), include_first=True))["0040"]


def test_arima_short_scopes_equal_the_plain_fit(spark):
    df = walk(spark, 95, (70,))
    got = flags(detect(df, "arima", ("price",), rows(30)))
    x = df.toPandas().sort_values("trade_ts").price.to_numpy()
    for start in range(0, 95, 30):
        part = x[start : start + 30]
        w = np.diff(part)
        back = np.append(0.0, w[:-1])
        e = np.array(arima.residuals(w, back, *arima.parameters(arima.fit_long(w, back)), 0.0))
        want = [False, *(np.abs(e) > 3 * e.std(ddof=1))]
        assert [got[f"{start + i:04d}"] for i in range(len(part))] == want


@BOTH
def test_iforest_flags_the_wanted_share_and_the_extremes(spark, chunk):
    df = trades(spark)
    got = detect(df, "iforest", ("price", "volume"))
    frame = ordered(df)
    hit = flags(got)
    for _, part in frame.groupby("symbol"):
        share = np.mean([hit[u] for u in part.uuid])
        assert 0.02 <= share <= 0.055
        assert hit[part.loc[part.price.idxmax(), "uuid"]]
    again = flags(detect(df.repartition(7), "iforest", ("price", "volume")))
    assert again == hit


@settings(deadline=None, max_examples=60)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=80), st.integers(0, 10**6))
def test_tree_steps_are_ordered_and_complete(values, seed):
    splits, paths = iforest.grow(np.array(values), np.random.default_rng(seed))
    assert splits == sorted(splits) and len(paths) == len(splits) + 1


DEGENERATE = {
    "empty": [],
    "one row": [("1", "a", 1.0, 1.0, 0)],
    "constant": [(str(i), "a", 0.1, 5.0, i) for i in range(40)],
    "all null": [(str(i), "a", None, None, i) for i in range(20)],
    "null runs": [(str(i), "a", None if i < 3 or i > 25 or i == 9 else 1.0, 2.0, i) for i in range(30)],
    "one instant": [(str(i), "a", 3.0, 3.0, 7) for i in range(30)],
}


@pytest.mark.parametrize("name", DEGENERATE)
@pytest.mark.parametrize("method", DETECTORS)
def test_degenerate_input_never_flags(spark, name, method):
    raw = spark.createDataFrame(
        DEGENERATE[name], "uuid string, symbol string, price double, volume double, s long"
    )
    df = raw.withColumn("trade_ts", F.timestamp_seconds("s"))
    params = {} if method not in ("prominence", "neighbour") else {"threshold": 1.5}
    out = detect(df, method, **params).select("uuid", "price_flag", "volume_flag").collect()
    assert len(out) == len(DEGENERATE[name])
    assert not any(r.price_flag or r.volume_flag for r in out)


@BOTH
@pytest.mark.parametrize("scope", [whole(), rows(80)])
def test_arima_passes_over_missing_values(spark, chunk, scope):
    """Flags are those of the rows with a value alone; a missing value is no jump to zero."""
    df = walk(spark, 400, (150, 301)).withColumn("price", F.col("price") + 1000)
    gone = F.col("uuid").isin("0040", "0041", "0200", "0399")
    holed = df.withColumn("price", F.when(~gone, F.col("price")))
    found = flags(detect(holed, "arima", ("price",), scope))
    assert len(found) == 400 and not any(found[u] for u in ("0040", "0041", "0042", "0200", "0201", "0399"))
    assert found["0150"] and found["0301"]
    if scope == whole():
        assert {u for u, f in found.items() if f} == {u for u, f in flags(detect(df.filter(~gone), "arima", ("price",))).items() if f}


@pytest.mark.parametrize("method", ["zscore", "iqr", "neighbour", "sliding", "arima"])
def test_flags_do_not_depend_on_partitioning(spark, method):
    df = trades(spark)
    scope = rows(30) if method != "sliding" else whole()
    assert flags(detect(df.repartition(1), method, scope=scope)) == flags(
        detect(df.repartition(13), method, scope=scope)
    )


def test_ten_rows_cannot_exceed_three_deviations(spark):
    made = [(f"{i:02d}", "a", 1000.0 if i in (5, 15) else 1.0, 1.0, i) for i in range(21)]
    df = spark.createDataFrame(made, "uuid string, symbol string, price double, volume double, s long")
    df = df.withColumn("trade_ts", F.timestamp_seconds("s"))
    assert not any(flags(detect(df, "zscore", scope=rows(10))).values())
    assert sum(flags(detect(df, "zscore", scope=rows(11))).values()) >= 1


def test_scopes_name_their_groups(spark):
    df = trades(spark)
    for scope in (time_window("1 hour"), by_columns("uuid")):
        assert detect(df, "zscore", scope=scope).count() == df.count()
    with pytest.raises(ValueError):
        detect(df, "guess")
    with pytest.raises(ValueError):
        rows(0)


@pytest.mark.parametrize("method", ["prominence", "arima", "iforest"])
def test_repeated_local_hour_keeps_times(spark, method):
    """Times pass through Python unharmed in a zone whose clock goes back."""
    made = [(f"{i:03d}", "a", float(i * 7 % 11), 1_698_537_600 + i * 120) for i in range(120)]
    df = spark.createDataFrame(made, "uuid string, symbol string, price double, s long")
    df = df.withColumn("trade_ts", F.timestamp_seconds("s"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        out = detect(df, method, ("price",)).select("s", F.unix_seconds("trade_ts").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(out) == 120 and all(r.s == r.t for r in out)
