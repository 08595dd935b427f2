"""Click log as newline-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Holds a line that is no JSON object of the schema; NULL for the others.
MALFORMED = "_malformed"

# One object per line; the time is in seconds since 1970, whole or with a fraction.
CLICK_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("received_at", T.DoubleType()),
        T.StructField(MALFORMED, T.StringType()),
    ]
)


class EmptySource(RuntimeError):
    """The source holds no rows; loading it would wipe the table it feeds."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The same DataFrame, or EmptySource. Looks for one row only."""
    if df.isEmpty():
        raise EmptySource(f"no rows in {what}")
    return df


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """All click objects under a folder. The schema is declared: inferring it
    would read every file twice. A line that does not fit it is kept in `_malformed`, so
    that it can be counted."""
    lines = spark.read.schema(CLICK_SCHEMA).option("columnNameOfCorruptRecord", MALFORMED)
    return require_rows(lines.json(path), path)
