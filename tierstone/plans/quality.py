"""Quality gates: is a table filled, are its keys present and unique."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import Contract
from tierstone.sources.ndjson import MALFORMED


class GateFailed(RuntimeError):
    pass


def gates(
    df: DataFrame, table: str, unique: str | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """Rows (table, check, failures, passed) from one pass over the table.

    `failures` counts offending rows: missing values, or rows beyond the first
    of a key. A table without rows fails the first check.
    """
    measures = [F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("not_empty")]
    for name in required:
        measures.append(F.count_if(F.col(name).isNull()).alias(f"{name}_present"))
    if unique:
        measures.append((F.count(unique) - F.count_distinct(unique)).alias(f"{unique}_unique"))
    measured = df.agg(*measures)
    return (
        measured.unpivot([], list(measured.columns), "check", "failures")
        .select(F.lit(table).alias("table"), "check", "failures")
        .withColumn("passed", F.col("failures") == 0)
    )


def lost_values(source: DataFrame, contract: Contract) -> DataFrame:
    """Gate rows for values that were there in the source and are NULL in the declared
    type, per column whose type differs, and for lines that were no JSON object.

    One pass over the source; a table with nothing to cast gives no row. Whole-number
    and fractional epochs of the click log are no loss.
    """
    measures = []
    for name, kind in contract.fields:
        have = source.schema[name].dataType
        value = F.col(name)
        if have == kind or (kind.typeName() == "timestamp" and have.typeName() in ("long", "integer", "double")):
            continue
        lost = value.isNotNull() & value.try_cast(kind).isNull()
        measures.append(F.count_if(lost).alias(f"{name}_kept"))
    if MALFORMED in source.columns:
        broken = F.col(MALFORMED).isNotNull()
        nothing = F.lit(True)
        for name in contract.columns:
            nothing = nothing & F.col(name).isNull()
        measures.append(F.count_if(broken).alias("lines_parsed"))
        measures.append(F.count_if(broken & nothing).alias("lines_with_values"))
    empty = source.sparkSession.createDataFrame([], "table string, check string, failures long, passed boolean")
    if not measures:
        return empty
    measured = source.agg(*measures)
    counted = measured.unpivot([], list(measured.columns), "check", "failures")
    named = counted.select(F.lit(contract.name).alias("table"), "check", "failures")
    return named.withColumn("passed", F.col("failures") == 0)


def all_gates(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> None:
    """Raise GateFailed if any gate failed. The result has one row per check, not per row."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        listed = ", ".join(f"{r['table']}: {r['check']} ({r['failures']})" for r in failed)
        raise GateFailed(listed)
