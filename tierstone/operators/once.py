"""Expressions that are costly enough to be evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read rather than recompute.

    A filter on a plain derived column is pushed below the projection with the
    expression copied into it, so a regular expression or JSON path runs once
    more for every predicate. Exploding a one-element array keeps such filters
    above it, stays in generated code, and lets filters on other columns pass.
    For columns every reader needs only: an unused one is still computed.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
