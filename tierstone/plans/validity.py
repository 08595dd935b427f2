"""Past loads as validity intervals: each load stores what it changes, not a whole copy.

A version is a row's content with the time from which it was there, how many such rows
there were, and the time at which that ended. Loads only append: one opens versions,
a later one ends them. Storage grows with changes, and a past state is the versions whose
interval holds the moment.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.operators.latest import CHANGE, changes
from tierstone.plans.history import LoadHistory
from tierstone.scratch import kept

#: Equal rows are stored as one with their number, up to so many; more take several pieces,
#: so that no task writes out all rows of a content that a third of the table has.
PIECE_ROWS = 10_000

_TIME = T.TimestampType()


class IntervalHistory(LoadHistory):
    """Loads of one table, stored as changes and readable as of their times.

    Content is compared by whole rows, and equal rows are counted, so keys may be NULL or
    repeated. Columns of map type cannot be compared. Loads come in ascending number and
    time; one that died before its log row is not read, and may be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        super().__init__(spark, path)
        self.schema = schema
        self._stored = (
            T.StructType()
            .add("row", schema)
            .add("opened_in", "long")
            .add("piece", "long")
            .add("n", "long")
            .add("opened_at", _TIME)
            .add("ended_at", _TIME)
        )

    def add(self, df: DataFrame, load_id: int, loaded_at: datetime, operation: str = "overwrite") -> int:
        """Store a whole load as its difference to the state before it."""
        present = df.select(F.struct(*self.schema.names).alias("row"), F.lit(1).alias("change"))
        return self._store(present, True, load_id, loaded_at, operation)

    def add_increment(
        self, changed: DataFrame, keys: Sequence[str], newest_by: Sequence[str], load_id: int, loaded_at: datetime
    ) -> int:
        """Store what a delivery of changed rows changes in the state before it. Rows without
        a whole key are new, as in `upsert`."""
        current = self.as_of(loaded_at)
        signed = changes(current, changed, keys, newest_by)
        signed = signed.select(F.struct(*self.schema.names).alias("row"), F.col(CHANGE).alias("change"))
        return self._store(signed, False, load_id, loaded_at, "upsert")

    def _store(self, signed: DataFrame, whole: bool, load_id: int, loaded_at: datetime, operation: str) -> int:
        self._in_order(load_id, loaded_at)
        moment = F.lit(loaded_at.isoformat(" ")).cast(_TIME)
        nothing, number = F.lit(None), F.lit(0).cast("long")
        before = self._open(self._loads()).select("row", "opened_in", "opened_at", F.col("n").alias("was"), number.alias("change"))
        comes = signed.select(
            "row", nothing.cast("long").alias("opened_in"), nothing.cast(_TIME).alias("opened_at"),
            number.alias("was"), F.col("change").cast("long").alias("change"),
        )
        # One shuffle; equal rows are added up before it, and at most one version is open per content.
        met = before.unionByName(comes).groupBy("row").agg(
            F.max("opened_in").alias("opened_in"), F.max("opened_at").alias("opened_at"),
            F.sum("was").alias("was"), F.sum("change").alias("change"),
        )
        now = F.col("change") if whole else F.col("was") + F.col("change")
        state = kept(met.select("row", "opened_in", "opened_at", "was", now.alias("now")).where("was <> now"), "changes")
        ends = _pieces(state.where("was > 0"), "was").withColumn("ended_at", moment)
        opens = _pieces(state.where("now > 0"), "now").withColumns(
            {"opened_in": F.lit(load_id).cast("long"), "opened_at": moment, "ended_at": nothing.cast(_TIME)}
        )
        ends.unionByName(opens).write.mode("overwrite").parquet(self._load_path(load_id))
        rows = self._open([*self._loads(), load_id]).agg(F.sum("n")).first()[0] or 0
        self._complete(load_id, loaded_at, operation, rows)
        return rows

    def _in_order(self, load_id: int, loaded_at: datetime) -> None:
        if self._is_logged(load_id):
            raise ValueError(f"load {load_id} is already complete")
        if not self._loads():
            return
        limit = F.lit(loaded_at.isoformat(" ")).cast(_TIME)
        if not self.log().where((F.col("load_id") > load_id) | (F.col("loaded_at") > limit)).isEmpty():
            raise ValueError(f"load {load_id} is older than one that is complete")

    def _loads(self, condition: Column | None = None) -> list[int]:
        """Numbers of the complete loads; one log row each."""
        if not self._has_log():
            return []
        log = self.log() if condition is None else self.log().where(condition)
        return sorted(r["load_id"] for r in log.collect())

    def _versions(self, loads: Sequence[int]) -> DataFrame:
        """The versions of some loads; a version has two rows at most, one if it is open."""
        if not loads:
            stored = self.spark.createDataFrame([], self._stored)
        else:
            stored = self.spark.read.schema(self._stored).parquet(*(self._load_path(n) for n in loads))
        return stored.groupBy("row", "opened_in", "piece").agg(
            F.max("n").alias("n"), F.max("opened_at").alias("opened_at"), F.max("ended_at").alias("ended_at")
        )

    def _open(self, loads: Sequence[int]) -> DataFrame:
        return self._versions(loads).where("ended_at IS NULL")

    def intervals(self) -> DataFrame:
        """The table's columns with `valid_from`, `valid_to` (NULL: still there) and `n`, the
        number of equal rows in this interval, 10,000 at most a row."""
        return self._versions(self._loads()).select(
            "row.*", F.col("opened_at").alias("valid_from"), F.col("ended_at").alias("valid_to"), "n"
        )

    def as_of(self, moment: datetime) -> DataFrame:
        """The table as it stood at a moment: the versions whose interval holds it. Loads
        after it are not opened."""
        limit = F.lit(moment.isoformat(" ")).cast(_TIME)
        loads = self._loads(F.col("loaded_at") <= limit)
        if not loads:
            raise LookupError(f"no load at or before {moment}")
        holds = (F.col("opened_at") <= limit) & (F.col("ended_at").isNull() | (F.col("ended_at") > limit))
        return _rows(self._versions(loads).where(holds))

    def version(self, load_id: int) -> DataFrame:
        """The table as one load left it."""
        if not self._is_logged(load_id):
            raise LookupError(f"no complete load {load_id}")
        return _rows(self._open(self._loads(F.col("load_id") <= load_id)))


def _pieces(state: DataFrame, count: str) -> DataFrame:
    """One row per piece of a content, with the rows it stands for."""
    last = F.floor((F.col(count) - 1) / PIECE_ROWS).cast("long")
    split = state.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    n = F.least(F.lit(PIECE_ROWS).cast("long"), F.col(count) - F.col("piece") * PIECE_ROWS)
    return split.select("row", "opened_in", "piece", n.alias("n"), "opened_at")


def _rows(versions: DataFrame) -> DataFrame:
    """Every row as often as it was there."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return versions.select("row", copies.alias("copy")).select("row.*")
