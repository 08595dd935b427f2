"""Click log ingest as a stream over a folder of JSON objects."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import CONTRACTS
from tierstone.plans import bronze
from tierstone.sinks.ledger import Ledger
from tierstone.sources.ndjson import CLICK_SCHEMA, MALFORMED


def click_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Bronze page views as an unbounded DataFrame; new objects become new rows."""
    raw = (
        spark.readStream.schema(CLICK_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .json(path)
    )
    return bronze.pageviews(raw)


def ingest_available(stream: DataFrame, target: str, checkpoint: str, files_per_day: int = 4) -> None:
    """Append everything that has arrived to Parquet, by day, then stop.

    An object may hold events of any day. Each batch is regrouped so that a day fills
    `files_per_day` files at most, however many objects came; that many tasks share
    the rows of a heavy day.

    The file sink and the checkpoint together make each object count once, also
    when a run is killed and started again. There is no state to bound.
    """
    by_day = stream.withColumn("part_received_at", F.to_date("received_at"))
    spread = F.pmod(F.xxhash64(*stream.columns), F.lit(files_per_day))
    query = (
        by_day.repartition("part_received_at", spread).writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("part_received_at")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    return bronze.pageviews(spark.read.parquet(target))


class ClickTable:
    """A table of clicks fed by a stream: replays are dropped, late clicks kept apart.

    A click is told by all its columns. The watermark is the latest time seen in earlier
    batches less `delay`, as Spark's own is; Spark's stateful operators drop what is older
    than it without a trace, so the batch function sets such clicks apart itself. The state
    against which replays are found is the table's own rows from the watermark's day on: other
    day folders are not opened, and there is no second copy of it that could differ.

    Each batch writes one folder of its own and then its entry in a ledger of (query, batch).
    A batch that Spark repeats after a crash overwrites what it had left, or, if its entry is
    there, changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, delay: str = "3 days", query: str = "clicks") -> None:
        self.spark, self.path, self.delay, self.query = spark, path.rstrip("/"), delay, query
        self._columns = CONTRACTS["bronze.pageviews"].columns

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={self.query}-{batch}"

    def _read(self, kind: str) -> DataFrame:
        """Rows of complete batches with their day and batch."""
        schema = T.StructType([*CONTRACTS["bronze.pageviews"].schema, T.StructField("day", T.DateType()), T.StructField("batch", T.StringType())])
        done = [r["step"] for r in self._ledger().entries().select("step").collect()]
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        return rows.where(F.col("batch").isin(done))

    def _ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/_ledger")

    def rows(self) -> DataFrame:
        """Clicks taken, each once."""
        return self._read("taken").select(*self._columns)

    def late(self) -> DataFrame:
        """Clicks older than the watermark, or without a time, as often as they came."""
        return self._read("late").select(*self._columns)

    def entries(self) -> DataFrame:
        """Batches with the clicks each has taken."""
        return self._ledger().entries()

    def watermark(self) -> datetime | None:
        """The latest time taken, less the delay."""
        latest = self._read("taken").agg(F.max("received_at") - F.expr(f"INTERVAL {self.delay}")).first()[0]
        return latest

    def take(self, batch: DataFrame, number: int) -> None:
        """One batch; the function for `foreachBatch`."""
        ledger, step = self._ledger(), f"{self.query}-{number}"
        if ledger.is_done(step):
            return
        mark = self.watermark()
        time, limit = F.col("received_at"), F.lit(None if mark is None else mark.isoformat(" ")).cast("timestamp")
        behind = time.isNull() | F.coalesce(time < limit, F.lit(False))
        rows = batch.select(*self._columns).withColumn("day", F.to_date("received_at"))
        rows.where(behind).write.mode("overwrite").partitionBy("day").parquet(self._folder("late", number))
        fresh = rows.where(~behind).distinct()
        if mark is not None:
            recent = self._read("taken").where((F.col("day") >= F.to_date(limit)) & (time >= limit))
            same = [fresh[c].eqNullSafe(recent[c]) for c in self._columns]
            fresh = fresh.join(recent, reduce(Column.__and__, same), "left_anti")
        taken = self._folder("taken", number)
        fresh.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(taken)
        ledger.mark(step, self.spark.read.schema(fresh.schema).parquet(taken).count())

    def ingest_available(self, stream: DataFrame, checkpoint: str) -> None:
        """Take everything that has arrived, then stop."""
        query = (
            stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
