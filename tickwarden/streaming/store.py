"""Tables kept from micro-batches: compaction into day files, a manifest, and what each file holds.

Beside the folders `batch_id=N` that the live job writes, a table has
    _days/trade_date=D/v=V/   the rows of a day as compaction V left them, by symbol and time
    _zones/v=V/               per live file and symbol: rows, and the range of each time column
    _blooms/v=V/              per live file: bitmaps of the hashes of its ids
    _commits/v=V/             one row: up to which batch compaction V goes
Version V counts once its commit is there; until then, and for a retry, readers go by the version
before.  Reads look at zones or bitmaps first and open only files that may hold what is asked,
besides the batches that no compaction has taken in yet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwarden.operators import serve

# Rows of a file that compaction aims at.
FILE_ROWS = 1_000_000
# Rows per bitmap of 32,768 bits; about one of 16 files is then opened in vain.
BITMAP_ROWS = 2048
BITMAP_BITS = 32768
# Files that a read names one by one; beyond it, it takes the days' folders.
NAMED_FILES = 10_000
TIMES = ("trade_ts", "ingestion_ts")


def _there(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _hash(uuid: Column) -> Column:
    return F.xxhash64(uuid)


@dataclass(frozen=True)
class Store:
    """One table; `schema` without the folder columns."""

    spark: SparkSession
    path: str
    schema: T.StructType

    # ---- what is there ----

    @property
    def columns(self) -> list[str]:
        return [*self.schema.names, "batch_id", "trade_date"]

    def exists(self) -> bool:
        return bool(self._folders(self.path))

    def version(self) -> tuple[int, int]:
        """(version, last batch in it); (0, -1) before the first compaction."""
        commits = _there(lambda: self.spark.read.schema("upto long, v int").parquet(f"{self.path}/_commits"))
        last = commits.agg(F.max(F.struct("v", "upto")).alias("last")).first()["last"] if commits else None
        return (last["v"], last["upto"]) if last else (0, -1)

    def zones(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/_zones/v={version}")

    def waiting(self, upto: int) -> DataFrame:
        """Rows of batches that no compaction has taken in: only their folders are looked into."""
        folders = [f"{self.path}/{name}" for name, number in self._batches() if number > upto]
        full = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("trade_date", T.DateType())])
        if not folders:
            return self.spark.createDataFrame([], full).select(*self.columns)
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*folders).select(*self.columns)

    def _batches(self) -> list[tuple[str, int]]:
        """The batches' folders and numbers."""
        names = [path.rpartition("/")[2] for path in self._folders(self.path)]
        return [(name, int(name.partition("=")[2])) for name in names if name.startswith("batch_id=")]

    def _system(self, path: str):
        """Hadoop's file system for a path, as Spark's own readers have it."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _folders(self, path: str) -> list[str]:
        system, at = self._system(path)
        if not system.exists(at):
            return []
        return [f"{path}/{s.getPath().getName()}" for s in system.listStatus(at) if s.isDirectory()]

    def _files(self, files: Sequence[str]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("trade_date", T.DateType()), T.StructField("v", T.IntegerType())])
        if not files:
            return self.spark.createDataFrame([], full).select(*self.columns)
        return self.spark.read.schema(full).option("basePath", f"{self.path}/_days").parquet(*files).select(*self.columns)

    def _chosen(self, zones: DataFrame) -> DataFrame:
        """The rows of the files that `zones` names, or of their days where the files are too many to name."""
        files = [r["file"] for r in zones.select("file").distinct().limit(NAMED_FILES + 1).collect()]
        if len(files) <= NAMED_FILES:
            return self._files(sorted(files))
        days = zones.select("trade_date", "v").distinct().collect()  # one per day
        return self._files([f"{self.path}/_days/trade_date={r['trade_date']}/v={r['v']}" for r in days])

    # ---- compaction ----

    def compact(self, upto: int | None = None, file_rows: int = FILE_ROWS) -> int:
        """Take in the batches that wait (those up to `upto`); the version that readers see afterwards.

        Only days with new rows are written again, as one job, sorted by symbol and time.  Nothing that the
        present version names is touched, so a failure leaves readers where they were, and a retry
        replaces what it left.
        """
        version, before = self.version()
        fresh = self.waiting(before)
        if upto is not None:
            fresh = fresh.filter(F.col("batch_id") <= upto)
        found = fresh.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("last")).collect()  # one per day
        if not found:
            return version
        days, last = sorted(r["trade_date"] for r in found), max(r["last"] for r in found)
        changed = F.col("trade_date").isin(days)
        old = self.zones(version) if version else None
        rows = sum(r["n"] for r in found)
        if old is not None:
            rows += old.filter(changed).agg(F.sum("n")).first()[0] or 0
            fresh = self._chosen(old.filter(changed)).unionByName(fresh)
        made = version + 1
        order = ["trade_date", "symbol", "ingestion_ts", "uuid"]
        (
            fresh.repartitionByRange(max(1, -(-rows // file_rows)), *order)
            .sortWithinPartitions(*order)
            .withColumn("v", F.lit(made))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", 2 * file_rows).option("parquet.bloom.filter.enabled#uuid", "true")
            .partitionBy("trade_date", "v").parquet(f"{self.path}/_days")
        )
        written = self._files([f"{self.path}/_days/trade_date={d}/v={made}" for d in days])
        written = written.select("*", F.col("_metadata.file_path").alias("file"))
        ranges = [f(t).alias(f"{n}_{t}") for t in TIMES for n, f in (("low", F.min), ("high", F.max))]
        zones = written.groupBy("file", "trade_date", "symbol").agg(F.count(F.lit(1)).alias("n"), *ranges).withColumn("v", F.lit(made))
        self._carry("_zones", zones, version, made, changed)
        many = written.groupBy("file").agg(F.ceil(F.count(F.lit(1)) / BITMAP_ROWS).alias("maps"))
        at = _hash(F.col("uuid"))
        placed = written.join(F.broadcast(many) if rows // file_rows < NAMED_FILES else many, "file").select(
            "file", "trade_date", "maps", F.pmod(F.shiftright(at, 15), F.col("maps")).alias("map"), F.pmod(at, F.lit(BITMAP_BITS)).alias("bit")
        )
        blooms = placed.groupBy("file", "trade_date", "maps", "map").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self._carry("_blooms", blooms, version, made, changed)
        # one small file: it is there or not
        commit = self.spark.createDataFrame([(last,)], "upto long").coalesce(1)
        commit.write.mode("overwrite").parquet(f"{self.path}/_commits/v={made}")
        return made

    def _carry(self, name: str, new: DataFrame, version: int, made: int, changed: Column) -> None:
        """Write `new` with what the version before says of the other days."""
        if version:
            new = new.unionByName(self.spark.read.parquet(f"{self.path}/{name}/v={version}").filter(~changed))
        order = ["symbol", "low_ingestion_ts"] if name == "_zones" else ["map", "file"]
        new.sort(*order).write.mode("overwrite").parquet(f"{self.path}/{name}/v={made}")

    def vacuum(self) -> list[str]:
        """Delete what the present version has replaced: folders of its batches and of earlier versions.

        Readers that began on an earlier version fail, so leave time after a compaction.
        """
        version, upto = self.version()
        live = {(str(r["trade_date"]), r["v"]) for r in self.zones(version).select("trade_date", "v").distinct().collect()} if version else set()
        gone = [f"{self.path}/{name}" for name, number in self._batches() if number <= upto]
        for day in self._folders(f"{self.path}/_days"):
            for folder in self._folders(day):
                number = int(folder.rpartition("=")[2])
                if number <= version and (day.rpartition("=")[2], number) not in live:
                    gone.append(folder)
        for part in ("_zones", "_blooms", "_commits"):
            gone += [f for f in self._folders(f"{self.path}/{part}") if int(f.rpartition("=")[2]) < version]
        for folder in gone:
            system, at = self._system(folder)
            system.delete(at, True)
        return gone

    # ---- reads ----

    def live(self) -> DataFrame:
        """All rows."""
        version, upto = self.version()
        if not version:
            return self.waiting(upto)
        return self._chosen(self.zones(version)).unionByName(self.waiting(upto))

    def in_range(self, symbol: str, start, end, time: str = "ingestion_ts", closed: bool = True) -> DataFrame:
        """Rows of one symbol from `start` to `end`: of files whose zones meet the range, and of waiting batches."""
        version, upto = self.version()
        rows = self.waiting(upto)
        if version:
            near = (F.col("symbol") == symbol) & (F.col(f"high_{time}") >= serve._time(start)) & (F.col(f"low_{time}") <= serve._time(end))
            rows = self._chosen(self.zones(version).filter(near)).unionByName(rows)
        return serve.in_range(rows, symbol, start, end, time, closed)

    def trailing(self, symbol: str, as_of, width: str = "15 minutes", time: str = "ingestion_ts") -> DataFrame:
        now = serve._time(as_of)
        return self.in_range(symbol, now - F.expr(f"INTERVAL {width}"), now, time)

    def newest(self, symbol: str, n: int, time: str = "ingestion_ts", tie: str = "uuid") -> DataFrame:
        """The latest `n` rows of a symbol, from the files that can hold them.

        Zones that begin at or after some time hold at least n rows between them; files that end before it hold none of the latest n.
        """
        version, upto = self.version()
        rows = self.waiting(upto)
        if version:
            zones = self.zones(version).filter(F.col("symbol") == symbol)
            held = zones.select(F.col(f"low_{time}").alias("low"), "n").sort(F.desc("low")).limit(n).collect()  # at least a row each
            total, least = 0, None
            for r in held:
                total += r["n"]
                if total >= n:
                    least = r["low"]
                    break
            rows = self._chosen(zones if least is None else zones.filter(F.col(f"high_{time}") >= F.lit(least))).unionByName(rows)
        return serve.newest(rows, symbol, n, time, tie)

    def lookup(self, uuid: str) -> DataFrame:
        """The rows with an id, from the files whose bitmaps have its bit."""
        version, upto = self.version()
        rows = self.waiting(upto)
        if version:
            blooms, at = self.spark.read.parquet(f"{self.path}/_blooms/v={version}"), _hash(F.lit(uuid))
            bit = F.pmod(at, F.lit(BITMAP_BITS))
            byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            # the first bit of a byte is the lowest
            has = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
            files = blooms.filter((F.col("map") == F.pmod(F.shiftright(at, 15), F.col("maps"))) & has)
            rows = self._files([r["file"] for r in files.select("file").distinct().collect()]).unionByName(rows)
        return serve.lookup(rows, uuid)
