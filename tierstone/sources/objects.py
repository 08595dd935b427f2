"""Objects of a folder that have not been read yet, by a ledger of those that have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.plans import bronze
from tierstone.sinks.ledger import Ledger
from tierstone.sources.ndjson import CLICK_SCHEMA, MALFORMED

_IDENTITY = ("path", "modified", "length")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, modified and length of every object below a folder; no object is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


class ClickIngest:
    """Click objects into bronze rows, each object by one load.

    A load first stages which objects are its own: those of the listing that no load before it
    has. Then it reads these and stages their rows. A load that died goes on from what it has
    staged, and a load that is done gives what it has given. An object that is written anew
    (another time or length) is a new object and is read as a whole; a load without new
    objects has no rows.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/_ledger")

    def _loads(self) -> list[int]:
        steps = [r["step"] for r in self.ledger.entries().select("step").collect()]
        return sorted(int(s.removeprefix("rows_")) for s in steps if s.startswith("rows_"))

    def objects(self, load: int) -> DataFrame:
        """The objects of a load."""
        return self.spark.read.parquet(self.ledger.folder(f"objects_{load}"))

    def take(self, folder: str, load: int) -> DataFrame:
        """Bronze page views of the objects that no earlier load has read."""
        before = [n for n in self._loads() if n != load]
        if before and load < before[-1] and not self.ledger.is_done(f"rows_{load}"):
            raise ValueError(f"load {load} comes after load {before[-1]}")

        def new_objects() -> DataFrame:
            found = listing(self.spark, folder)
            for number in before:
                found = found.join(self.objects(number), list(_IDENTITY), "left_anti")
            return found

        def rows() -> DataFrame:
            # Paths go through the driver, as any list of files that Spark reads does.
            paths = [r["path"] for r in own.select("path").collect()]
            reader = self.spark.read.schema(CLICK_SCHEMA).option("columnNameOfCorruptRecord", MALFORMED)
            lines = reader.json(paths) if paths else self.spark.createDataFrame([], CLICK_SCHEMA)
            return bronze.pageviews(lines)

        own = self.ledger.staged(f"objects_{load}", new_objects)
        return self.ledger.staged(f"rows_{load}", rows)

    def all_rows(self) -> DataFrame:
        """Rows of all loads, with the number of their load."""
        taken = None
        for load in self._loads():
            rows = self.spark.read.parquet(self.ledger.folder(f"rows_{load}")).withColumn("load_id", F.lit(load).cast("long"))
            taken = rows if taken is None else taken.unionByName(rows)
        if taken is None:
            raise LookupError("no load yet")
        return taken
