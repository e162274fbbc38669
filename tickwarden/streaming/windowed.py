"""Any detector over event-time windows of a stream, with its state in a folder.

Rows wait in files by window until the newest trade seen is `late` past the window's end; then the
window's rows are judged together, as a table of any size, and never again.  Rows whose
window has closed, that lie too far ahead of their arrival, or have no time go to a table of their own.
What is there after batch N depends on the batches alone, so a batch that runs twice leaves one copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwarden.operators.detectors import detect
from tickwarden.operators.scope import whole
from tickwarden.operators.series import Series

STATE = "closed long, batch_id long, flush int"


@dataclass(frozen=True)
class WindowJob:
    """Flags of `method` within tumbling windows of `width` per key of `series`.

    Folders under `root`: rows (by batch and window), flagged (judged windows), aside (rows left out, with
    the `reason`: late, early or untimed), state (up to which time windows are closed).  `early`: how far
    a trade may lie ahead of `arrival`, lest one wrong clock close windows for all; None for any.
    """

    root: str
    method: str = "zscore"
    columns: Sequence[str] = ("price", "volume")
    width: str = "1 hour"
    late: str = "10 minutes"
    early: str | None = None
    arrival: str = "ingestion_ts"
    series: Series = Series()
    params: Mapping = field(default_factory=dict)

    def start(self, trades: DataFrame, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
        writer = trades.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    # ---- a batch ----

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Put a batch's rows into their windows, then judge the windows it closes."""
        spark = batch.sparkSession
        before, _, _ = self._state(spark, batch_id)
        time = F.col(self.series.time)
        ahead = F.lit(False)
        if self.early is not None:
            ahead = time > F.col(self.arrival) + F.expr(f"INTERVAL {self.early}")
        # a window of a missing time would drop the row
        end = F.unix_micros(F.window(F.coalesce(time, F.timestamp_micros(F.lit(0))), self.width)["end"])
        reason = F.when(time.isNull(), "untimed").when(ahead, "early")
        if before is not None:
            reason = reason.when(end <= before, "late")
        held = batch.withColumns({"window_end": end, "reason": reason}).persist()
        try:
            facts = held.agg(F.max(F.when(F.col("reason").isNull(), F.unix_micros(time))).alias("latest"), F.count_if(F.col("reason").isNull()).alias("kept"),
                             F.count("reason").alias("aside")).first()
            if facts["kept"]:
                kept = held.filter("reason IS NULL").drop("reason")
                kept.write.mode("overwrite").partitionBy("window_end").parquet(f"{self.root}/rows/batch_id={batch_id}")
            if facts["aside"]:
                held.filter("reason IS NOT NULL").drop("window_end").write.mode("overwrite").parquet(f"{self.root}/aside/batch_id={batch_id}")
        finally:
            held.unpersist()
        closed = before
        if facts["latest"] is not None:
            wait = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(facts["latest"])) - F.expr(f"INTERVAL {self.late}"))).first()[0]
            closed = wait if before is None else max(before, wait)
        if closed is not None:
            self._judge(spark, before, closed, batch_id, 0)
            self._commit(spark, closed, batch_id, 0)

    def finish(self, spark: SparkSession) -> None:
        """Judge the windows still open, as at the end of input; rows that come for them later are late."""
        before, batch_id, flush = self._state(spark, None)
        rows = self._rows(spark)
        if rows is None:
            return
        last = rows.agg(F.max("window_end")).first()[0]
        if before is None or last > before:
            self._judge(spark, before, last, batch_id, flush + 1)
            self._commit(spark, last, batch_id, flush + 1)

    # ---- steps ----

    def _judge(self, spark: SparkSession, after: int | None, upto: int, batch_id: int, flush: int) -> None:
        rows = self._rows(spark)
        if rows is None:
            return
        due = (F.col("window_end") <= upto) & (F.col("batch_id") <= batch_id)
        if after is not None:
            due = due & (F.col("window_end") > after)
        due = rows.filter(due).drop("batch_id")
        if due.isEmpty():
            return
        inner = Series((*self.series.keys, "window_end"), self.series.time, self.series.ties)
        flagged = detect(due, self.method, self.columns, whole(), inner, **self.params)
        flagged = flagged.withColumn("window_end", F.timestamp_micros("window_end"))
        flagged.write.mode("overwrite").parquet(f"{self.root}/flagged/batch_id={batch_id}/flush={flush}")

    def _commit(self, spark: SparkSession, closed: int, batch_id: int, flush: int) -> None:
        row = spark.createDataFrame([(closed,)], "closed long").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/state/batch_id={batch_id}/flush={flush}")

    def _state(self, spark: SparkSession, batch_id: int | None) -> tuple[int | None, int, int]:
        """(time up to which windows were closed, batch, flush) before a batch, or at last."""
        found = _read(spark, f"{self.root}/state", STATE)
        if found is None:
            return None, -1, -1
        if batch_id is not None:
            found = found.filter(F.col("batch_id") < batch_id)
        last = found.agg(F.max(F.struct("batch_id", "flush", "closed")).alias("last")).first()["last"]
        return (last["closed"], last["batch_id"], last["flush"]) if last else (None, -1, -1)

    def _rows(self, spark: SparkSession) -> DataFrame | None:
        rows = _read(spark, f"{self.root}/rows")
        if rows is None:
            return None
        return rows.withColumns({c: F.col(c).cast("long") for c in ("batch_id", "window_end")})

    # ---- results ----

    def flagged(self, spark: SparkSession) -> DataFrame | None:
        """All judged rows, with `window_end`; None before the first."""
        found = _read(spark, f"{self.root}/flagged")
        return None if found is None else found.drop("batch_id", "flush")

    def aside(self, spark: SparkSession) -> DataFrame | None:
        """Rows left out, with the reason; None if there are none."""
        found = _read(spark, f"{self.root}/aside")
        return None if found is None else found.drop("batch_id")


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
