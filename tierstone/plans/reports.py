"""Reports over the layer tables.

Every top-k ends its order with the item number, so equal values give the same
rows on every run, and says where NULL conversion goes.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.operators.rank import top_k

# Rows of a result that a display shows.
SHOWN_ROWS = 100


# --- on gold.item_performance ---------------------------------------------------


def top_earners(performance: DataFrame, k: int = 10) -> DataFrame:
    return top_k(performance, k, F.desc("revenue"), F.asc("item_id")).select(
        "item_name", "item_category", "orders", "revenue", "pageviews",
        F.round("conversion_rate", 4).alias("conversion_rate"),
    )


def best_converters(performance: DataFrame, k: int = 10) -> DataFrame:
    """Viewed items by conversion, highest first; never-sold items come last."""
    seen = performance.where(F.col("pageviews") > 0)
    return top_k(seen, k, F.desc_nulls_last("conversion_rate"), F.asc("item_id")).select(
        "item_name", "item_category", "orders", "pageviews",
        F.round("conversion_rate", 4).alias("conversion_rate"),
    )


def traffic_without_sales(performance: DataFrame, k: int = 10) -> DataFrame:
    """Viewed items by conversion, lowest first; never-sold items (NULL) lead."""
    seen = performance.where(F.col("pageviews") > 0)
    return top_k(seen, k, F.asc_nulls_first("conversion_rate"), F.asc("item_id")).select(
        "item_name", "item_category", "pageviews", "orders", "conversion_rate"
    )


def top_by(performance: DataFrame, metric: str, k: int = 5) -> DataFrame:
    return top_k(performance, k, F.desc_nulls_last(metric), F.asc("item_id")).select(
        "item_id", "item_name", "revenue", "conversion_rate"
    )


def revenue_by_category(performance: DataFrame) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in ("orders", "revenue", "pageviews")]
    return (
        performance.groupBy("item_category")
        .agg(*sums)
        .withColumn("revenue", F.col("revenue").try_cast("decimal(20,2)"))
        .orderBy(F.desc("revenue"), F.asc("item_category"))
    )


def average_by(df: DataFrame, group: str, amount: str, rows: str, average: str) -> DataFrame:
    """Rows and mean amount, to two places, per group."""
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias(rows),
            F.round(F.avg(amount), 2).cast("double").alias(average),
        )
        .orderBy(F.desc(average), F.asc(group))
    )


# --- on other tables --------------------------------------------------------------


def segment_sizes(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("engagement_segment")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(F.desc("user_count"), F.asc("engagement_segment"))
    )


def email_validity(silver_users: DataFrame) -> DataFrame:
    """Users with a valid, an invalid and no e-mail: up to three rows."""
    return silver_users.groupBy("valid_email").agg(F.count(F.lit(1)).alias("user_count"))


def channel_counts(bronze_pageviews: DataFrame) -> DataFrame:
    """All traffic by channel, views without an item included."""
    return (
        bronze_pageviews.groupBy("channel")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("channel"))
    )


def on_channel(bronze_pageviews: DataFrame, channel: str) -> DataFrame:
    return bronze_pageviews.where(F.col("channel") == channel)


def received_since(
    bronze_pageviews: DataFrame, start: datetime, end: datetime | None = None
) -> DataFrame:
    """Views from `start` on, and before `end` if given."""
    moment = F.col("received_at")
    kept: Column = moment >= F.lit(start.isoformat(" ")).cast("timestamp")
    if end is not None:
        kept &= moment < F.lit(end.isoformat(" ")).cast("timestamp")
    return bronze_pageviews.where(kept)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name `t` and its number of rows `n`."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def count_parity(one: dict[str, DataFrame], other: dict[str, DataFrame]) -> DataFrame:
    """Rows of the same tables along two read paths, and whether they agree."""
    left = row_counts(one).withColumnRenamed("n", "n_one")
    right = row_counts(other).withColumnRenamed("n", "n_other")
    return left.join(right, "t", "full").select(
        "t", "n_one", "n_other", F.equal_null("n_one", "n_other").alias("agrees")
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Data files behind a DataFrame read from files, with the rows in each."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("record_count")
    )


# --- SQL text -----------------------------------------------------------------------


def run_sql(
    spark: SparkSession, text: str, bind: str | None = None, **views: DataFrame
) -> DataFrame:
    """The whole result of a SQL text. Keyword arguments are bound as views for it to
    read; with `bind` the result is a view of that name for later texts."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    result = spark.sql(text)
    if bind:
        result.createOrReplaceTempView(bind)
    return result


def shown(result: DataFrame, rows: int = SHOWN_ROWS) -> DataFrame:
    """What a display shows of a result: its first rows. Work goes on with the result."""
    return result.limit(rows)


def as_record(df: DataFrame) -> DataFrame:
    """The first row turned on its side: one (column, value) row per column."""
    pairs = [
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
        for name in df.columns
    ]
    return df.limit(1).select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
