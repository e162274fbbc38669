"""What a Python worker or a task holds does not grow with a series."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.operators import detectors, evaluate, stationarity
from tickwarden.operators.arima import arima_residuals


@pytest.fixture
def trades(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(str(i), "AB"[i % 5 == 0], 10 + math.sin(i * i) + (5 if i % 83 == 0 else 0), float(i * 37 % 101), start + dt.timedelta(seconds=i)) for i in range(600)]
    return spark.createDataFrame(rows, "uuid string, symbol string, price double, volume double, trade_ts timestamp")


def plan(df):
    return df._jdf.queryExecution().toString()


def near(got, wanted):
    return len(got) == len(wanted) and all(a[:-1] == b[:-1] and a[-1] == pytest.approx(b[-1], rel=1e-6, abs=1e-9) for a, b in zip(got, wanted))


def test_residuals_are_worked_out_in_chunks_for_python(trades, monkeypatch):
    def run():
        made = arima_residuals(trades, "price", fixed=(0.4, -0.3))
        return plan(made), made.select("uuid", "residual").orderBy("uuid").collect()

    whole, wanted = run()
    monkeypatch.setattr(session, "PYTHON_ROWS", 50)
    cut, got = run()
    assert "_chunk" in cut and "_chunk" not in whole and near(got, wanted)


def test_arima_flags_of_cut_series_are_those_of_whole_ones(trades, monkeypatch):
    def run():
        made = detectors.detect(trades, "arima", ("price",))
        return plan(made), sorted(map(str, made.select("uuid", "price_flag").collect()))

    _, wanted = run()
    monkeypatch.setattr(session, "PYTHON_ROWS", 50)
    cut, got = run()
    assert "arima-residuals" in cut and got == wanted


def test_dickey_fuller_blocks_are_small(trades, monkeypatch):
    wanted = stationarity.adf(trades, "price", max_lag=0).select("symbol", "n", "statistic").orderBy("symbol").collect()
    asked = []
    kept = stationarity.plan_layout
    monkeypatch.setattr(stationarity, "plan_layout", lambda *a, **k: asked.append(kept(*a, **k)) or asked[-1])
    monkeypatch.setattr(session, "PYTHON_ROWS", 50)
    got = stationarity.adf(trades, "price", max_lag=0).select("symbol", "n", "statistic").orderBy("symbol").collect()
    assert asked[0].chunk_rows == 50 and not asked[0].single and near(got, wanted)


def test_compared_methods_read_rows_stored_once(trades):
    rows = trades.withColumn("truth", (F.col("price") > 14).cast("int"))
    table = evaluate.compare_methods(rows, {"zscore": {}, "mad": {}}, {"price": "truth"})
    assert "compared-rows" in plan(table) and table.count() == 2


def test_forest_scores_of_cut_series_are_stored(chunked, trades):
    assert "forest-scores" in plan(detectors.detect(trades, "iforest", ("price",)))


def test_sliding_windows_take_tasks_by_their_rows(chunked, trades, monkeypatch):
    def run():
        made = detectors.detect(trades, "sliding", seconds=20, threshold=2, peers=False)
        return plan(made), sorted(map(str, made.select("uuid", "price_flag", "volume_flag").collect()))

    before, wanted = run()
    monkeypatch.setattr(session, "SORTED_ROWS", 20)
    after, got = run()
    assert "REPARTITION_BY_NUM" in after and "REPARTITION_BY_NUM" not in before and got == wanted
