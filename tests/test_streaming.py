import glob
import json

import pytest
from pyspark.sql import functions as F

from tests.oracle import canonical
from tickwarden import Series, by_columns, detect
from tickwarden.plans.fixtures import trades
from tickwarden.schemas import ENVELOPE, LABELLED_CSV, STOCKS, TABLE_SCHEMAS
from tickwarden.sources import decode, files, replay, stream, symbols
from tickwarden.streaming import job, sinks


@pytest.fixture
def incoming(spark, sf_dir, tmp_path):
    """The events as files of messages, to be streamed two at a time."""
    recorded = trades(spark, sf_dir).withColumn("day", F.dayofmonth("trade_ts"))
    messages = recorded.groupBy("day").agg(
        F.collect_list(
            F.struct(
                F.lit(None).cast("array<string>").alias("c"), F.col("price").alias("p"),
                F.col("symbol").alias("s"), F.unix_millis("trade_ts").alias("t"),
                F.col("volume").alias("v"),
            )
        ).alias("data")
    )
    path = str(tmp_path / "in")
    decode.encode(messages.withColumn("type", F.lit("trade")).repartition(6)).write.text(path)
    return path


def run(spark, path, root, state, **settings):
    texts = stream.file_stream(spark, path, "value string", "text", 2)
    query = job.start_job(
        job.trades_from_messages(stream.file_positions(texts)), root, state, "zscore", trigger={"availableNow": True},
        threshold=1.6, **settings,
    )
    query.awaitTermination()
    return {n: sinks.read_table(spark, f"{root}/{n}", s) for n, s in TABLE_SCHEMAS.items()}


def test_job_writes_every_trade_once_and_flags_per_batch(spark, sf_dir, incoming, tmp_path):
    root, state = str(tmp_path / "out"), str(tmp_path / "state")
    tables = run(spark, incoming, root, state)
    base = tables["stocks"]
    assert base.count() == trades(spark, sf_dir).count() == base.select("uuid").distinct().count()
    assert base.select("batch_id").distinct().count() == 3
    sizes = base.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("batch_size").alias("b"))
    assert all(r.n == r.b for r in sizes.collect())
    again = detect(base, "zscore", scope=by_columns("ingestion_ts"), series=Series(keys=()), threshold=1.6)
    for name, value in (("price_anomalies", "price"), ("volume_anomalies", "volume")):
        want = {r.uuid for r in again.filter(f"{value}_flag").collect()}
        assert {r.uuid for r in tables[name].collect()} == want != set()
    # nothing new: a restart adds nothing
    assert run(spark, incoming, root, state)["stocks"].count() == base.count()


def test_a_repeated_batch_replaces_itself(spark, sf_dir, tmp_path):
    batch = trades(spark, sf_dir).withColumn("ingestion_ts", F.current_timestamp())
    for _ in range(2):
        job.process_batch(
            batch, 4, "zscore", str(tmp_path), by_columns("ingestion_ts"), Series(keys=()), job.TABLES, {}
        )
    assert sinks.read_table(spark, f"{tmp_path}/stocks", STOCKS).count() == batch.count()


def test_tables_without_rows_read_as_empty(spark, tmp_path):
    empty = trades(spark, "/root/testdata/sf0.001").limit(0).withColumn("ingestion_ts", F.current_timestamp())
    job.process_batch(
        empty, 0, "zscore", str(tmp_path), by_columns("ingestion_ts"), Series(keys=()), job.TABLES, {}
    )
    assert not glob.glob(f"{tmp_path}/*")
    assert sinks.read_table(spark, f"{tmp_path}/stocks", STOCKS).count() == 0


def test_configurations_run_as_one_query(spark, sf_dir, tmp_path):
    from tickwarden.operators.detectors import run_configurations
    from tickwarden.plans.serving import trade_stream

    arriving = trade_stream(spark, sf_dir).withColumn("ingestion_ts", F.current_timestamp())
    job.start_configurations(
        arriving, str(tmp_path / "out"), str(tmp_path / "state"),
        {"price": [21600, 86400], "volume": [21600]}, {"price": 6, "volume": 30},
        {"price": "mad", "volume": "neighbour"}, {"availableNow": True},
    ).awaitTermination()
    batch = trades(spark, sf_dir).withColumn("ingestion_ts", F.current_timestamp())
    for column, sizes, limit, method in (("price", [21600, 86400], 6, "mad"), ("volume", [21600], 30, "neighbour")):
        want = run_configurations(batch, sizes, limit, column, method).select("uuid", "window_size")
        got = spark.read.parquet(f"{tmp_path}/out/{column}_configurations").select("uuid", "window_size")
        assert canonical(got.columns, got.collect()) == canonical(want.columns, want.collect())


def test_messages_without_trades_give_no_rows(spark):
    lines = ['{"data":[],"type":"trade"}', '{"data":null,"type":"ping"}', "not json",
             '{"data":[{"c":["1",null],"p":2.5,"s":"a","t":1500,"v":1.0}],"type":"trade"}']
    raw = spark.createDataFrame([(bytearray(v, "utf8"),) for v in lines], "value binary")
    messages = decode.decode(raw)
    flat = decode.normalise(decode.explode_trades(messages)).collect()
    assert len(flat) == 1 and flat[0].trade_conditions == ["1", None]
    assert flat[0].trade_ts.microsecond == 500_000 and len(flat[0].uuid) == 64
    assert decode.explode_trades(messages, outer=True).count() == 4
    with pytest.raises(ValueError):
        decode.decode(raw, form="xml")


def test_avro_schema_follows_the_spark_schema():
    made = json.loads(decode.avro_schema(ENVELOPE))
    trade = made["fields"][0]["type"]["items"]
    kinds = {f["name"]: f["type"] for f in trade["fields"]}
    assert kinds == {"c": [{"type": "array", "items": ["string", "null"]}, "null"], "p": "double", "s": "string", "t": "long", "v": "double"}
    assert made["fields"][1] == {"name": "type", "type": "string"}


def test_ids_agree_between_runs_and_tell_positions_apart(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 3.0, 0), ("a", 1, 2.0, 3.0, 1)], "s string, t long, p double, v double, at int")
    same = decode.normalise(df).select("uuid").distinct().count()
    apart = decode.normalise(df, decode.content_id(F.col("at"))).select("uuid").distinct().count()
    assert (same, apart) == (1, 2)


def test_replay_streams_recorded_files(spark, tmp_path):
    recorded = spark.range(40).select(
        F.lit("a").alias("symbol"), F.lit("2024-01-01 00:00:00.000000+0000").alias("trade_ts"),
        F.col("id").cast("double").alias("price"), F.lit(None).cast("string").alias("trade_conditions"),
        F.lit("trade").alias("type"), F.lit(1.0).alias("volume"),
        F.lit(0.0).alias("price_anomaly"), F.lit(0.0).alias("volume_anomaly"),
    )
    files.write_csv(recorded.repartition(4), str(tmp_path / "in"))
    query = replay.replay(
        spark, str(tmp_path / "in"), LABELLED_CSV, {"format": "text", "path": str(tmp_path / "out")},
        str(tmp_path / "state"), once=True,
    )
    query.awaitTermination()
    flat = decode.explode_trades(decode.decode(spark.read.text(str(tmp_path / "out"))))
    assert sorted(r.p for r in flat.collect()) == [float(i) for i in range(40)]
    assert flat.filter("c is null and s = 'a' and t > 1700000000000").count() == 40
    with pytest.raises(ValueError):
        files.first_rows(recorded, 3, [])


def test_symbol_checks_split_the_rows(spark, sf_dir):
    df, known = trades(spark, sf_dir), spark.createDataFrame([("click",), ("click",), ("CLICK",)], "symbol string")
    good, bad = symbols.valid(df, known), symbols.rejected(df, known)
    assert good.count() + bad.count() == df.count()
    assert {r.symbol for r in good.select("symbol").distinct().collect()} == {"click"}


def test_kafka_options():
    made = stream.kafka_options("host:1", "topic", 1, 1000, failOnDataLoss="false")
    assert made == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "topic", "startingOffsets": "latest",
        "minPartitions": "1", "maxOffsetsPerTrigger": "1000", "failOnDataLoss": "false",
    }
