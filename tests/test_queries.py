"""Every registered query against its SQL twin, and the plans that matter at scale."""

import io
from contextlib import redirect_stdout

import pytest

from tests.oracle import compare, connect
from tickwarden import detect, whole
from tickwarden.operators import serve
from tickwarden.plans.catalog import ORACLES, QUERIES
from tickwarden.plans.fixtures import stocks, trades


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(frame, duck, ORACLES[name]) is None
    else:
        assert frame.count() > 0


@pytest.mark.parametrize(
    "name", ["zscore_series_flags", "iqr_series_flags", "prominence_peaks", "sliding_z_flags", "acf",
             "combined_for_evaluation", "shapiro", "rolling_mean3", "decompose_additive"],
)
def test_query_in_small_chunks_without_broadcast(spark, sf_dir, duck, name):
    spark.conf.set("spark.tickwarden.chunkRows", "150")
    spark.conf.set("spark.tickwarden.broadcastRows", "2")
    try:
        assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.tickwarden.chunkRows")
        spark.conf.unset("spark.tickwarden.broadcastRows")


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_base_columns_do_not_run_the_detector(spark, sf_dir):
    flagged = detect(stocks(spark, sf_dir), "zscore", scope=whole())
    text = plan(serve.base_rows(flagged))
    assert "stddev" not in text and "Python" not in text


def test_range_reads_push_filters_and_prune_columns(spark, sf_dir):
    text = plan(serve.in_range(trades(spark, sf_dir), "click", "2024-01-05", "2024-01-06", "trade_ts").select("price"))
    assert "EqualTo(event_type,click)" in text and "user_id" not in text


def test_series_statistics_move_no_rows(spark, sf_dir):
    """Whole-series scores broadcast the few statistics; the rows are never shuffled or sorted."""
    text = plan(detect(trades(spark, sf_dir), "zscore", scope=whole()))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Window" not in text


@pytest.mark.parametrize("name", ["zscore_rows15_flags", "sliding_z_flags", "neighbour_peaks", "mad_series_flags"])
def test_core_detectors_stay_in_the_jvm(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Python tasks run though the package is on the driver's path alone."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "import __spark_entry__ as e\n"
        "from tickwarden.session import local_session\n"
        "spark = local_session('2')\n"
        "print('rows', e.queries()['arima_series_flags'](spark, '/root/testdata/sf0.001').count())\n"
    )
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300
    )
    assert "rows " in done.stdout, done.stderr[-2000:]
