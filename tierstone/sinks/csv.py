"""CSV hand-off for consumers that do not read the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write CSV with a header line in every part; consumers take `*.csv`.

    `single_file` has one task write one part: for consumers that need it, and for
    tables one task can carry. The layout is the caller's choice at every size.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
