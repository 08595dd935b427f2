"""The shop's four sources, derived from the bundled test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierstone.operators.once import with_once

_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once per process, not per query."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _days_after(start: str, days: str) -> str:
    """SQL for midnight, a number of days after a date."""
    return f"CAST(date_add(DATE'{start}', CAST({days} AS INT)) AS TIMESTAMP)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_mktsegment AS first_name",
        "substring(c_name, 10, 9) AS last_name",
        """CASE WHEN c_custkey % 10 = 0 THEN NULL
                WHEN c_custkey % 10 = 1 THEN concat('bad-', c_custkey)
                ELSE concat('u', c_custkey, '@example.com') END AS email""",
        _days_after("2023-01-01", "c_custkey % 28") + " AS created_at",
        _days_after("2023-02-01", "c_custkey % 5") + " AS updated_at",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "lower(p_type) AS category",
        "CAST(p_retailprice AS DECIMAL(7,2)) AS price",
        "p_size AS inventory",
        _days_after("2023-01-01", "p_partkey % 28") + " AS created_at",
        _days_after("2023-02-01", "p_partkey % 5") + " AS updated_at",
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return bought.selectExpr(
        "event_id AS id",
        "user_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS item_id",
        "CAST(event_id % 5 + 1 AS INT) AS quantity",
        "CAST(value AS DECIMAL(12,2)) AS purchase_price",
        "CAST(ts AS TIMESTAMP) AS created_at",
        "CAST(ts AS TIMESTAMP) AS updated_at",
    )


def bulk_purchases(spark: SparkSession, sf_dir: str, buyers: bool = True) -> DataFrame:
    """Order lines as purchases: many more of them, but all dated at midnight.

    The buyer is on the order. Tables that do not ask who bought leave it out
    (`buyers=False`), which spares the join of the two largest inputs; a line
    without an order stays either way.
    """
    lines = table(spark, sf_dir, "lineitem")
    if buyers:
        orders = table(spark, sf_dir, "orders")
        lines = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left")
    return lines.selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        "o_custkey AS user_id" if buyers else "CAST(NULL AS BIGINT) AS user_id",
        "l_partkey AS item_id",
        "l_linenumber AS quantity",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS purchase_price",
        "CAST(l_shipdate AS TIMESTAMP) AS created_at",
        "CAST(l_shipdate AS TIMESTAMP) AS updated_at",
    )


def clicks(spark: SparkSession, sf_dir: str, whole: bool = True) -> DataFrame:
    """Page views in the shape of the click log, time as timestamp.

    Viewers are a third of the customers; their number is a scalar subquery. Readers
    that ask neither for user nor for URL say `whole=False`: both are then plain
    expressions that Spark leaves out with the JSON they are made of.
    """
    viewers = table(spark, sf_dir, "customer").selectExpr("count(*) DIV 3").scalar()
    seen = table(spark, sf_dir, "events").where("event_type <> 'purchase'")
    key = F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)")
    keyed = with_once(seen, "k", key) if whole else seen.withColumn("k", key)
    return keyed.select(
        (F.expr("event_id * 7919 + k * 31") % viewers).alias("user_id"),
        F.expr(
            """CASE event_type WHEN 'error' THEN '/about'
                               WHEN 'signup' THEN concat('/cart/', k)
                               ELSE concat('/products/', 2 * k) END AS url"""
        ),
        F.col("event_type").alias("channel"),
        F.expr("CAST(ts AS TIMESTAMP) AS received_at"),
    )


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page views with whole epoch seconds, as the click log stores them."""
    return clicks(spark, sf_dir).withColumn("received_at", F.unix_timestamp("received_at"))
