"""Slices, fits, stored tables, windows over batches, exact draws."""

import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwarden import Series, detect, rows
from tickwarden.operators import arima, evaluate, inject
from tickwarden.operators.series import plan_layout
from tickwarden.operators.trailing import _pieces, placed, trailing_scores
from tickwarden.plans.fixtures import stocks, trades
from tickwarden.schemas import STOCKS
from tickwarden.sources import stream
from tickwarden.streaming import job
from tickwarden.streaming.sinks import write_batch_table
from tickwarden.streaming.store import Store
from tickwarden.streaming.windowed import WindowJob

SERIES = Series(("symbol",), "trade_ts", ("uuid",))


def burst(spark):
    """A quiet time, a burst, and a quiet time again: 2,000 rows of one symbol."""
    mixer = np.random.default_rng(3)
    steps = np.concatenate([np.full(500, 100.0), np.full(1000, 0.1), np.full(500, 50.0)])
    frame = pd.DataFrame({"symbol": "a", "uuid": [f"{i:05d}" for i in range(2000)], "us": np.cumsum(steps * 1e6).astype(np.int64), "price": mixer.standard_normal(2000)})
    frame.loc[mixer.choice(2000, 100, replace=False), "price"] = np.nan
    frame.loc[1400:1450, "price"] = 7.0
    df = spark.createDataFrame(frame).withColumn("price", F.when(~F.isnan("price"), F.col("price")))
    return df.withColumn("trade_ts", F.timestamp_micros("us")), frame


@pytest.mark.parametrize("seconds", [30, 5000, 40000])
def test_windows_over_many_slices(spark, seconds):
    df, frame = burst(spark)
    spark.conf.set("spark.tickwarden.chunkRows", "40")
    try:
        layout = plan_layout(df, SERIES)
        assert len(layout.splits) >= 40
        pieces, folded = _pieces(df, ["price"], layout, True)
        places = placed(pieces, layout, [seconds * 1_000_000]).cache()
        # a row has one cell of its own and asks one other; neither kind is more than two slices
        assert not folded and places.count() == 2000
        assert places.groupBy("_f", "_g").count().agg(F.max("count")).first()[0] <= 80
        assert places.groupBy("_q", "_g").count().agg(F.max("count")).first()[0] <= 80
        got = trailing_scores(df, ["price"], [seconds], SERIES).toPandas().sort_values("us")
    finally:
        spark.conf.unset("spark.tickwarden.chunkRows")
    series = frame.set_index(pd.to_datetime(frame.us, unit="us")).price
    window = series.rolling(f"{seconds}s", closed="both")
    want = ((series - window.mean()) / window.std()).to_numpy()
    flat = window.max().to_numpy() == window.min().to_numpy()
    known = ~np.isnan(want) & ~flat
    assert np.allclose(got.price_z.to_numpy(float)[known], want[known], atol=1e-9)
    assert np.isnan(got.price_z.to_numpy(float)[flat | series.isna().to_numpy()]).all()


def test_rows_without_time_and_rows_of_one_instant(spark):
    rows_ = [("a", "1", 1.0, 5.0), ("a", "2", 1.0, 7.0), ("a", "3", 1.0, 9.0), ("a", "4", None, 1.0), ("a", "5", None, 2.0)]
    df = spark.createDataFrame(rows_, "symbol string, uuid string, s double, price double").withColumn("trade_ts", F.timestamp_seconds("s"))
    with_peers = {r.uuid: r.price_z for r in trailing_scores(df, ["price"], [10], SERIES).collect()}
    alone = {r.uuid: r.price_z for r in trailing_scores(df, ["price"], [10], SERIES, peers=False).collect()}
    assert with_peers == {"1": -1.0, "2": 0.0, "3": 1.0, "4": None, "5": None}
    assert alone["1"] is None and alone["2"] == pytest.approx(0.5**0.5) and alone["3"] == 1.0


# ---- fits ------------------------------------------------------------------------------------------


def moving(phi, theta, n, seed=1):
    e = np.random.default_rng(seed).standard_normal(n)
    w = np.zeros(n)
    for t in range(n):
        w[t] = e[t] + (phi * w[t - 1] + theta * e[t - 1] if t else 0)
    return w


def test_stretches_compose_and_give_the_gradient():
    w = moving(0.5, 0.3, 101)
    back = np.concatenate([[0.0], w[:-1]])
    phi, theta = np.array([0.2, -0.7]), np.array([0.4, 0.95])
    whole = arima.stretch(w[:, None], back[:, None], phi[None], theta[None])
    whole = whole[0][:, 0], whole[1][:, :, 0]
    cut = arima.then(arima.long_stretch(w[:37], back[:37], phi, theta), arima.long_stretch(w[37:], back[37:], phi, theta))
    assert all(np.allclose(a, b) for a, b in zip(whole, cut))

    def cost(p, q):
        return sum(x * x for x in loop(w, back, p, q))

    for i in range(2):
        products = whole[1][2:, 2:, i]
        assert products[0, 0] == pytest.approx(cost(phi[i], theta[i]))
        for j, (dp, dq) in enumerate([(1e-6, 0), (0, 1e-6)]):
            slope = (cost(phi[i] + dp, theta[i] + dq) - cost(phi[i] - dp, theta[i] - dq)) / 2e-6
            assert 2 * products[0, 1 + j] == pytest.approx(slope, rel=1e-4)


def loop(w, back, phi, theta, e=0.0):
    for a, b in zip(w, back):
        e = a - phi * b - theta * e
        yield e


def test_residuals_in_pieces():
    w = moving(0.5, 0.3, 1003)
    back = np.concatenate([[0.0], w[:-1]])
    for phi, theta, e in [(0.3, 0.9, 2.0), (0.0, 0.0, 1.0), (-0.5, -0.99, -3.0)]:
        assert np.allclose(arima.residuals(w, back, phi, theta, e), list(loop(w, back, phi, theta, e)))


@pytest.mark.parametrize("phi, theta", [(0.6, 0.3), (-0.4, 0.8), (0.995, -0.5)])
def test_fits_reach_the_parameters(phi, theta):
    w = moving(phi, theta, 6000)
    back = np.concatenate([[0.0], w[:-1]])
    state = arima.fit_long(w, back)
    found = arima.parameters(state)
    assert state[-1] == 1 and abs(found[0] - phi) < 0.05 and abs(found[1] - theta) < 0.05
    many = arima.fit_many(w[:, None], back[:, None])
    assert np.allclose(np.array(arima.parameters(many))[:, 0], found, atol=1e-6)
    if phi > 0.99:
        assert found[0] > 0.98  # no bound short of 1


def test_fits_by_chunk_are_reported(spark, monkeypatch):
    w = np.concatenate([moving(0.6, 0.3, 400), moving(-0.3, 0.5, 300, 2)])
    names = ["a"] * 400 + ["b"] * 300
    frame = pd.DataFrame({"symbol": [*names, "c", "c"], "uuid": [f"{i:04d}" for i in range(702)], "s": [*range(700), 0, 1], "price": [*np.cumsum(w), 1.0, 2.0]})
    df = spark.createDataFrame(frame).withColumn("trade_ts", F.timestamp_seconds("s")).drop("s")
    one = {r.symbol: r for r in arima.arima_fit(df, "price").collect()}
    spark.conf.set("spark.tickwarden.chunkRows", "97")
    try:
        cut = {r.symbol: r for r in arima.arima_fit(df, "price").collect()}
        flags = {r.uuid for r in detect(df, "arima", ["price"]).filter("price_flag").collect()}
    finally:
        spark.conf.unset("spark.tickwarden.chunkRows")
    assert set(one) == set(cut) == {"a", "b", "c"} and not one["c"].converged and not cut["c"].converged and cut["c"].phi is None
    for name in "ab":
        assert one[name].converged and cut[name].converged
        assert cut[name].phi == pytest.approx(one[name].phi, abs=1e-6) and cut[name].theta == pytest.approx(one[name].theta, abs=1e-6)
    assert flags == {r.uuid for r in detect(df, "arima", ["price"]).filter("price_flag").collect()}


def test_a_descent_that_needs_more_looks_says_so(monkeypatch):
    monkeypatch.setattr(arima, "EVALUATIONS", 2)
    w = moving(0.6, 0.3, 500)
    state = arima.fit_many(w[:, None], np.concatenate([[0.0], w[:-1]])[:, None])
    assert state[-1, 0] == 2


# ---- stored tables ---------------------------------------------------------------------------------


@pytest.fixture
def table(spark, sf_dir, tmp_path):
    made = Store(spark, f"{tmp_path}/stocks", STOCKS)
    base = stocks(spark, sf_dir).select(*STOCKS.names)
    for batch_id in range(3):
        write_batch_table(base.filter(F.pmod(F.col("uuid").cast("long"), F.lit(3)) == batch_id), made.path, batch_id, None)
    return made, base


def ids(df):
    return sorted(r.uuid for r in df.select("uuid").collect())


def test_compaction_keeps_rows_and_few_files(table):
    store, base = table
    before = len(store.waiting(-1).inputFiles())
    assert ids(store.live()) == ids(base)
    assert store.compact(upto=1) == 1 and store.version() == (1, 1)
    assert ids(store.live()) == ids(base) and store.waiting(1).count() == base.filter("uuid % 3 = 2").count()
    assert store.compact() == 2 == store.compact()
    assert ids(store.live()) == ids(base) and store.waiting(2).count() == 0
    days = base.select(F.to_date("trade_ts")).distinct().count()
    files = store.live().inputFiles()
    assert len(files) <= days + 1 < before and len(set(files)) == len(files)
    gone = store.vacuum()
    assert gone and ids(store.live()) == ids(base) and store.vacuum() == []


def test_a_failed_compaction_changes_nothing(table, monkeypatch):
    store, base = table
    store.compact(upto=0)

    def broken(self, name, *rest):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "_carry", broken)
        with pytest.raises(RuntimeError):
            store.compact()
    assert store.version() == (1, 0) and ids(store.live()) == ids(base)
    store.compact()
    assert store.version() == (2, 2) and ids(store.live()) == ids(base)


def test_reads_open_few_files(table):
    store, base = table
    store.compact(file_rows=40)
    everything = len(store.live().inputFiles())
    low, high = "2024-01-05 00:00:00", "2024-01-06 00:00:00"
    near = store.in_range("click", low, high)
    inside = base.filter(f"symbol = 'click' AND ingestion_ts BETWEEN '{low}' AND '{high}'")
    assert ids(near) == ids(inside) != [] and len(near.inputFiles()) <= 4 < everything / 5
    newest = store.newest("purchase", 5)
    want = base.filter("symbol = 'purchase'").orderBy(F.desc("ingestion_ts"), "uuid").limit(5)
    assert ids(newest) == ids(want) and len(newest.inputFiles()) < everything / 5
    found = store.lookup("777")
    assert ids(found) == ["777"] and len(found.inputFiles()) <= 4
    assert ids(store.lookup("none")) == []
    assert len(store.trailing("view", "2024-01-12 12:00:00", time="trade_ts").inputFiles()) <= 4


# ---- windows over batches --------------------------------------------------------------------------


def arrivals(spark, lines):
    df = spark.createDataFrame(lines, "uuid string, symbol string, s double, price double, volume double")
    return df.withColumns({"trade_ts": F.timestamp_seconds("s"), "ingestion_ts": F.timestamp_seconds(F.lit(20_000))}).drop("s")


def test_windows_close_once_and_odd_rows_stand_aside(spark, tmp_path):
    windows = WindowJob(str(tmp_path), width="1 hour", late="10 minutes", early="1 day")
    first = [(f"a{i}", "x" if i % 3 else None, 10.0 * i, float(i % 5) + 100 * (i == 77), 1.0) for i in range(300)]
    windows.process(arrivals(spark, first), 0)
    assert windows.flagged(spark) is None
    second = [("b1", "x", 3700.0, 1.0, 1.0), ("b2", "x", 4300.0, 2.0, 1.0), ("early", "x", 9e6, 1.0, 1.0), ("untimed", "x", None, 1.0, 1.0)]
    for _ in range(2):  # a batch that runs twice
        windows.process(arrivals(spark, second), 1)
    closed = windows.flagged(spark)
    assert sorted(r.uuid for r in closed.collect()) == sorted(f"a{i}" for i in range(300))
    assert [r.uuid for r in closed.filter("price_flag").collect()] == ["a77"]
    windows.process(arrivals(spark, [("late", "x", 100.0, 1.0, 1.0), ("b3", "x", 4400.0, 3.0, 1.0)]), 2)
    windows.finish(spark)
    windows.finish(spark)
    done = sorted(r.uuid for r in windows.flagged(spark).collect())
    assert done == sorted([f"a{i}" for i in range(300)] + ["b1", "b2", "b3"])
    assert {(r.uuid, r.reason) for r in windows.aside(spark).collect()} == {("late", "late"), ("early", "early"), ("untimed", "untimed")}
    # after the end of input its windows stay closed, later ones open as before
    windows.process(arrivals(spark, [("c1", "x", 5000.0, 1.0, 1.0), ("c2", "x", 15000.0, 1.0, 1.0)]), 3)
    windows.finish(spark)
    assert {"c2"} == {r.uuid for r in windows.flagged(spark).collect()} - set(done)
    assert {r.uuid for r in windows.aside(spark).filter("reason = 'late'").collect()} == {"late", "c1"}


@pytest.mark.parametrize("method", ["zscore", "mad"])
def test_windows_of_any_size_of_batch_agree(spark, sf_dir, tmp_path, method):
    base = trades(spark, sf_dir).withColumn("ingestion_ts", F.col("trade_ts"))
    end = F.unix_micros(F.window("trade_ts", "6 hours")["end"])
    inner = Series(("symbol", "window_end"), "trade_ts", ("uuid",))
    want = detect(base.withColumn("window_end", end), method, ["price", "volume"], series=inner)
    want = sorted((r.uuid, r.price_flag, r.volume_flag) for r in want.collect())
    for parts in (1, 3):
        windows = WindowJob(f"{tmp_path}/{method}{parts}", method, width="6 hours", late="1 hour")
        day = F.dayofmonth("trade_ts")
        for i in range(parts):
            windows.process(base.filter((day > 31 / parts * i) & (day <= 31 / parts * (i + 1))), i)
        windows.finish(spark)
        assert sorted((r.uuid, r.price_flag, r.volume_flag) for r in windows.flagged(spark).collect()) == want


def test_messages_need_a_position(spark, tmp_path):
    lines = ['{"data":[{"c":null,"p":1.0,"s":"a","t":1000,"v":1.0}],"type":"trade"}'] * 3
    sent = spark.createDataFrame([(x,) for x in lines], "value string").repartition(1)
    sent.write.text(str(tmp_path / "texts"))
    sent.write.parquet(str(tmp_path / "rows"))
    texts, stored = spark.read.text(str(tmp_path / "texts")), spark.read.parquet(str(tmp_path / "rows"))
    with pytest.raises(ValueError):
        job.trades_from_messages(texts)
    ids = lambda messages, **more: job.trades_from_messages(messages, **more).select("uuid").distinct().count()
    assert ids(stream.file_positions(stored)) == 3
    assert ids(stream.file_positions(texts)) == ids(texts, position=[]) == 1


# ---- draws and agreement ---------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [None, "50"])
def test_exactly_so_many_draws(spark, chunk):
    sizes = {"a": 400, "b": 37, "c": 3, "d": 2}
    frame = pd.DataFrame([(s, f"{s}{i:04d}", i, 10.0 + i % 7, 0.5) for s, n in sizes.items() for i in range(n)], columns=["symbol", "uuid", "s", "price", "volume"])
    df = spark.createDataFrame(frame).withColumn("trade_ts", F.timestamp_seconds("s")).drop("s")
    if chunk:
        spark.conf.set("spark.tickwarden.chunkRows", chunk)
    try:
        # distinct places, so that draws can be counted
        got = inject.add_anomalies(df, 0.1, picks=lambda c, k, n: F.pmod(k * 7 + 2, n)).toPandas()
        ends = inject.add_anomalies(df, 0.1, picks=lambda c, k, n: k * 0 + (n - 1)).toPandas()
    finally:
        spark.conf.unset("spark.tickwarden.chunkRows")
    assert got.groupby("symbol").price_anomaly.sum().to_dict() == {"a": 40, "b": 3, "c": 1, "d": 0}
    assert sorted(ends[ends.price_anomaly == 1].uuid) == ["a0398", "b0035", "c0001"]
    assert got.groupby("symbol").size().to_dict() == sizes


def test_missing_values_count_as_zero_in_the_agreement(spark):
    values = [(f"{i:02d}", "a", float(i), None if i == 5 else 50.0 + i % 3, 1.0, int(i == 5), 0) for i in range(15)]
    df = spark.createDataFrame(values, "uuid string, symbol string, s double, price double, volume double, price_pred int, volume_pred int")
    df = df.withColumn("trade_ts", F.timestamp_seconds("s"))
    filled = {r["column"]: r.tp for r in evaluate.agreement(df, "zscore", rows(15)).collect()}
    apart = {r["column"]: r.tp for r in evaluate.agreement(df, "zscore", rows(15), missing=None).collect()}
    assert filled["price"] == 1 and apart["price"] == 0


def test_a_plain_local_session_has_scratch_space_and_clears_it(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import os, sys; sys.path.insert(0, {repo!r})\n"
        "from tickwarden import session\n"
        "spark = session.local_session('2')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "made = session.stored(spark.range(5), 'x')\n"
        "assert made.count() == 5 and made.repartition(2).checkpoint().count() == 5\n"
        "print('cleared', session.clear_scratch(spark), session.clear_scratch(spark))\n"
        "print('folder', session.checkpoint_dir(spark))\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=300)
    assert "cleared 1 0" in done.stdout, done.stderr[-2000:]
    folder = done.stdout.split("folder ")[1].split()[0]
    assert folder.startswith(str(tmp_path)) and not os.path.exists(folder)


def jobs(spark, work):
    """Spark jobs that `work` runs."""
    group = f"group-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_table_is_counted_once(spark, sf_dir, monkeypatch):
    from tickwarden.operators import series as module

    base = trades(spark, sf_dir).withColumn("truth", F.lit(0))

    def compared():
        runs = {"zscore": {}, "mad": {}, "iqr": {}, "sliding": {}, "prominence": {}}
        return evaluate.compare_methods(base, runs, {"price": "truth", "volume": "truth"})

    class Forgetful(module._Facts):
        def get(self, about, *question, work):
            return work()

    with monkeypatch.context() as patch:
        patch.setattr(module, "_FACTS", Forgetful())
        each_time = jobs(spark, compared)
        want = sorted(map(str, compared().collect()))
    monkeypatch.setattr(module, "_FACTS", module._Facts())
    once = jobs(spark, compared)
    assert 0 < once <= 0.6 * each_time
    assert jobs(spark, compared) == 0 and sorted(map(str, compared().collect())) == want
    # another table is counted for itself
    assert module.count_groups(base.filter("symbol = 'click'"), ["symbol"]) != module.count_groups(base, ["symbol"])
