"""Ids, predictions, tied quantiles, NULL keys and the shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.operators.evaluate import join_predictions
from tickwarden.operators.quantiles import quantiles
from tickwarden.streaming import job
from tickwarden.streaming.windows import window_zscore


def test_equal_trades_of_equal_messages_have_ids_of_their_own(spark):
    message = '{"data":[{"c":null,"p":1.5,"s":"A","t":1000,"v":2.0},{"c":null,"p":1.5,"s":"A","t":1000,"v":2.0}],"type":"trade"}'
    rows = spark.createDataFrame([(message, 0, 7), (message, 0, 8)], "value string, partition int, offset long")
    got = job.trades_from_messages(rows)
    assert "_place" not in got.columns and got.count() == 4 == got.select("uuid").distinct().count()
    again = job.trades_from_messages(rows.repartition(3))
    assert {r.uuid for r in got.collect()} == {r.uuid for r in again.collect()}


def test_repeated_predictions_do_not_multiply_rows(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "uuid string")
    said = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 0)], "uuid string, price_pred int")
    got = join_predictions(base, said, ["price_pred"])
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 0), ("c", 0)]


@pytest.mark.parametrize("value", [0.6821770123928727, 0.1, 1 / 3])
def test_tied_values_are_their_own_quantiles_at_any_chunk_size(spark, value):
    for n in (101, 1000, 1777):
        rows = spark.range(n).select(F.lit("s").alias("k"), F.lit(value).alias("x"))
        for size in (100, 10**6):
            got = quantiles(rows, ["k"], {"q": "x"}, [0.05, 0.9, 0.95], chunk_rows=size).first()["q"]
            assert got == [value] * 3


def test_streamed_windows_keep_null_keys(spark, tmp_path):
    rows = spark.range(100).select(
        F.when(F.col("id") % 4 > 0, "A").alias("symbol"), F.timestamp_seconds(F.col("id") * 60).alias("trade_ts"),
        F.col("id").cast("double").alias("price"), F.lit(1.0).alias("volume"),
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.range(1).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.lit(10**6)).alias("trade_ts"),
                          F.lit(0.0).alias("price"), F.lit(0.0).alias("volume")).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = window_zscore(stream).writeStream.format("memory").queryName("null_keys").option("checkpointLocation", str(tmp_path / "s"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("null_keys").filter("price < 100 AND symbol IS NULL").count() == 25


def test_no_silent_local_folder_on_a_cluster():
    conf = {}
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=conf.get, set=conf.__setitem__), sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    )
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(cluster)
