"""What the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.scratch import new_folder

#: Rows per Arrow batch where rows carry whole texts, so that a batch of long ones fits a worker.
TEXT_BATCH_ROWS = 256

#: Bytes per Arrow batch where a row is large; a batch has one row at least.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> SparkSession:
    """Limit the rows Spark hands to a Python worker at once; never raises the limit."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_now = int(spark.conf.get(setting, "10000"))
    if set_now <= 0 or set_now > rows:
        spark.conf.set(setting, str(rows))
    return spark


def short_batches(spark: SparkSession, size: int = BATCH_BYTES) -> SparkSession:
    """Limit the bytes Spark hands to a Python worker at once; never raises the limit."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", (spark.conf.get(setting, None) or "-1").strip().lower()).groups()
    set_now = int(number) << 10 * "bkmgtp".index(unit or "b")
    if set_now <= 0 or set_now > size:
        spark.conf.set(setting, str(size))
    return spark


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows written to the shared folder and read from there; options are the writer's.

    Cuts lineage: what comes after reads files every executor sees, so a lost
    executor costs its running tasks and nothing that was computed before.
    """
    path = f"{new_folder(df.sparkSession, label)}/rows"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """Split of rows that depends on the key alone: crc32 of its text, modulo."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def share(*parts: Column) -> Column:
    """A number in [0, 1) that is a hash of the parts."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("share"), *parts), 11)
    return bits.cast("double") / float(1 << 53)


def row_key(*columns: str) -> list[Column]:
    """128 bits that stand for a row's content, as columns row_a and row_b."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns]
    return [
        F.xxhash64(F.lit("a"), *parts).alias("row_a"),
        F.xxhash64(F.lit("b"), *reversed(parts)).alias("row_b"),
    ]


def python_values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most `size` rows."""
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        held.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield flush()
    if held:
        yield flush()
