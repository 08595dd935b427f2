"""Whether two tables hold the same rows, told from fingerprints per table and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row. Which columns are NULL is hashed along, as
    NULLs alone would leave no trace."""
    absent = F.concat(*(F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in sorted(columns)))
    values = [F.col(f"`{c}`") for c in sorted(columns)]
    return F.xxhash64(absent, *values), F.xxhash64(F.lit("other"), *values, absent)


def fingerprints(df: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day (all rows: one NULL day): day, n, and sums of the rows' hashes.

    Sums do not depend on the order of rows or files, and count a row as often as it is
    there, so a row changed, lost or doubled shows. They are exact: below 10^19 rows they
    fit the decimal. Tasks add up before the shuffle, which carries one row per task and
    day. Columns go in by name; maps cannot be hashed. A table without rows has no days.
    """
    one, other = row_hashes(df.columns)
    when = F.lit(None).cast("date") if day is None else day
    hashed = df.select(when.alias("day"), one.cast(_WIDE).alias("one"), other.cast(_WIDE).alias("other"))
    return hashed.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("one").cast(_WIDE).alias("sum_one"), F.sum("other").cast(_WIDE).alias("sum_other")
    )


def content_parity(name: str, one: DataFrame, other: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day of a table along two read paths: t, day, n_one, n_other, agrees. A day that
    only one of them has is listed with no rows on the other side."""
    sides = [
        fingerprints(df.select(*(f"`{c}`" for c in one.columns)), day).withColumn("side", F.lit(side))
        for side, df in enumerate((one, other))
    ]
    n = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))
    both = sides[0].unionByName(sides[1]).groupBy("day")
    same = F.expr("count(*) = 2 AND min(n) = max(n) AND min(sum_one) = max(sum_one) AND min(sum_other) = max(sum_other)")
    return both.agg(n(0).alias("n_one"), n(1).alias("n_other"), same.alias("agrees")).select(
        F.lit(name).alias("t"), "day", "n_one", "n_other", "agrees"
    )
