"""Activity of users as states that merge: distinct days without reading the views again.

A state has one row per user and month: the days with a view as bits of one number, and
the views. States of any parts of the views, overlapping in days or not, merge by OR and
sum; a count of distinct days is a count of bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def states(views: DataFrame) -> DataFrame:
    """user_id, month (its first day, NULL for views without a time), days, page_count.

    Partial aggregates leave one row per user and month before the shuffle; nothing is
    expanded. Views without a user are left out.
    """
    day = F.to_date("received_at")
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)
    return _reduced(
        views.where(F.col("user_id").isNotNull()).select(
            "user_id", F.trunc(day, "month").alias("month"), F.coalesce(bit, F.lit(0)).alias("days"),
            F.when(F.col("page").isNotNull(), 1).otherwise(0).cast("long").alias("page_count"),
        )
    )


def _reduced(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "month").agg(
        F.bit_or("days").alias("days"), F.sum("page_count").alias("page_count")
    )


def merged(*parts: DataFrame) -> DataFrame:
    """One state of several. Views that two parts share count twice, their days once."""
    return _reduced(reduce(DataFrame.unionByName, parts))


def visits_of(state: DataFrame) -> DataFrame:
    """Views, active days and last active day per user, as `gold.visits` has them."""
    # The highest bit is the last day of the month with a view.
    last = F.date_add("month", F.length(F.bin("days")) - 1)
    return state.groupBy("user_id").agg(
        F.sum("page_count").alias("page_count"),
        F.sum(F.bit_count("days")).cast("long").alias("day_count"),
        F.max(last).alias("last_day"),
    )
