"""Bronze: sources as they are, in declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import CONTRACTS
from tierstone.operators.conform import conform


def users(source: DataFrame) -> DataFrame:
    return conform(source, CONTRACTS["bronze.users"])


def items(source: DataFrame) -> DataFrame:
    return conform(source, CONTRACTS["bronze.items"])


def purchases(source: DataFrame) -> DataFrame:
    return conform(source, CONTRACTS["bronze.purchases"])


def pageviews(source: DataFrame) -> DataFrame:
    """Click log rows; numeric times are seconds since 1970."""
    if isinstance(source.schema["received_at"].dataType, T.NumericType):
        source = source.withColumn("received_at", F.timestamp_seconds("received_at"))
    return conform(source, CONTRACTS["bronze.pageviews"])
