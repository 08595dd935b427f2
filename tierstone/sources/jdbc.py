"""Database tables over JDBC, read in parallel ranges of a key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    fetch_size: int = 10_000

    def options(self, **extra: object) -> dict[str, str]:
        given = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": self.fetch_size,
            # A time without zone stays what it says; the JVM's zone does not shift it.
            "preferTimestampNTZ": "true",
            **extra,
        }
        return {name: str(value) for name, value in given.items() if value not in ("", None)}


def key_range_query(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"


def range_options(
    table: str, key: str, low: object, high: object, partitions: int
) -> dict[str, object]:
    """Options that split a table into `partitions` key ranges.

    The bounds only place the cuts: rows outside them are still read. An empty
    table has no bounds and is read in one piece.
    """
    if low is None or partitions <= 1:
        return {"dbtable": table}
    return {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": partitions,
    }


def read_table(
    spark: SparkSession, database: Database, table: str, key: str = "id", partitions: int = 16
) -> DataFrame:
    """Whole table, as `partitions` concurrent range scans over its primary key.

    The key bounds come from one aggregate that the database evaluates. Filters
    and column selections applied to the result are pushed into the scans.
    """
    reader = spark.read.format("jdbc")
    low = high = None
    if partitions > 1:
        query = key_range_query(table, key)
        low, high = reader.options(**database.options(query=query)).load().first()
    options = range_options(table, key, low, high, partitions)
    return spark.read.format("jdbc").options(**database.options(**options)).load()
