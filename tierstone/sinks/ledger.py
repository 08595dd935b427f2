"""A ledger of steps that are done, and what they left, in plain Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("done_at", T.TimestampType()),
    ]
)


class Ledger:
    """Steps under one path. A step counts once its entry is written, so what a step that
    died halfway has left is never read, and a run that is started again skips what is done.

    One writer at a time. Entries are one small file each; an object reads them once and
    then knows what it adds.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._done: set[str] | None = None

    def entries(self) -> DataFrame:
        """All entries: step, rows, done_at."""
        try:
            return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/_steps")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # nothing done yet
                return self.spark.createDataFrame([], _ENTRY)
            raise

    def is_done(self, step: str) -> bool:
        if self._done is None:
            self._done = {row["step"] for row in self.entries().select("step").collect()}
        return step in self._done

    def mark(self, step: str, rows: int | None = None) -> None:
        entry = self.spark.range(1).select(
            F.lit(step).alias("step"), F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("done_at")
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_steps")
        if self._done is not None:
            self._done.add(step)

    def folder(self, step: str) -> str:
        return f"{self.path}/{step}"

    def staged(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What a step has left; built and written first, if it is not done."""
        if not self.is_done(step):
            build().write.mode("overwrite").parquet(self.folder(step))
            self.mark(step)
        return self.spark.read.parquet(self.folder(step))

    def once(self, step: str, act: Callable[[], object]) -> None:
        """Do something that may be repeated, unless it is done."""
        if not self.is_done(step):
            act()
            self.mark(step)
