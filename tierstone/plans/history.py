"""Extensions over plain Parquet: past loads, changed columns, small files.

Nothing here is a table format. A history is a folder with one subfolder per
load plus a small log of loads; a load counts once its log row is written, so a
load that died halfway is never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.operators.latest import upsert

LOG_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)


class LoadHistory:
    """Loads of one table, each kept whole and readable as of its time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _load_path(self, load_id: int) -> str:
        return f"{self.path}/load_id={load_id}"

    def add(
        self, df: DataFrame, load_id: int, loaded_at: datetime, operation: str = "overwrite"
    ) -> int:
        """Store one load. Repeating a load that failed replaces its files; a load
        that succeeded is history and is not touched."""
        if self._is_logged(load_id):
            raise ValueError(f"load {load_id} is already complete")
        df.write.mode("overwrite").parquet(self._load_path(load_id))
        rows = self.spark.read.parquet(self._load_path(load_id)).count()
        self._complete(load_id, loaded_at, operation, rows)
        return rows

    def _complete(self, load_id: int, loaded_at: datetime, operation: str, rows: int) -> None:
        entry = self.spark.range(1).select(
            F.lit(load_id).cast("long").alias("load_id"),
            F.lit(loaded_at.isoformat(" ")).cast("timestamp").alias("loaded_at"),
            F.lit(operation).alias("operation"),
            F.lit(rows).cast("long").alias("row_count"),
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_log")

    def add_increment(
        self,
        changed: DataFrame,
        keys: Sequence[str],
        newest_by: Sequence[str],
        load_id: int,
        loaded_at: datetime,
    ) -> int:
        """Store the current state with changed rows applied, instead of reloading
        everything from the source. The state read stays as it is, so a failed
        attempt can be repeated."""
        current = self.as_of(loaded_at)
        return self.add(upsert(current, changed, keys, newest_by), load_id, loaded_at, "upsert")

    def _is_logged(self, load_id: int) -> bool:
        return self._has_log() and not self.log().where(F.col("load_id") == load_id).isEmpty()

    def _has_log(self) -> bool:
        try:
            self.log()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # no log yet
                return False
            raise
        return True

    def log(self) -> DataFrame:
        """Commit time, number, operation and size of every load."""
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/_log")

    def as_of(self, moment: datetime) -> DataFrame:
        """The table as it stood at a moment: the newest load not after it."""
        limit = F.lit(moment.isoformat(" ")).cast("timestamp")
        newest = (
            self.log()
            .where(F.col("loaded_at") <= limit)
            .orderBy(F.desc("loaded_at"), F.desc("load_id"))
            .first()
        )
        if newest is None:
            raise LookupError(f"no load at or before {moment}")
        return self.version(newest["load_id"])

    def version(self, load_id: int) -> DataFrame:
        """The table as one load left it."""
        return self.spark.read.parquet(self._load_path(load_id))


def read_evolved(
    spark: SparkSession, paths: list[str], columns: dict[str, tuple[T.DataType, list[str]]]
) -> DataFrame:
    """Files written under different column sets, as one table.

    `columns` maps each current column to its type and earlier names. A file
    without any of them gives NULL; file columns not named are dropped.
    """
    merged = spark.read.option("mergeSchema", "true").parquet(*paths)

    def current(name: str, kind: T.DataType, earlier: list[str]) -> Column:
        present = [F.col(c) for c in (name, *earlier) if c in merged.columns]
        value = F.coalesce(*present) if present else F.lit(None)
        return value.cast(kind).alias(name)

    return merged.select(
        *(current(name, kind, earlier) for name, (kind, earlier) in columns.items())
    )


def compact(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Rewrite rows into fewer, fuller files at a new place.

    Rebalancing merges small pieces and splits oversized ones towards the
    session's advisory partition size; no folder is forced into one task.
    """
    if partition_by is None:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
    else:
        fuller = df.hint("rebalance", partition_by)
        fuller.write.mode("overwrite").partitionBy(partition_by).parquet(path)
