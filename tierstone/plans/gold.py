"""Gold: one table per question.

Facts are reduced per key before anything is joined, so what is shuffled grows
with the number of items or users, not with the number of purchases or views,
and a hot item or user is a few partial sums rather than a hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import REVENUE
from tierstone.functions import clock, shop
from tierstone.operators.lookup import lookup
from tierstone.operators.rank import top_k

TOP_SELLERS = 10


def item_performance(items: DataFrame, purchases: DataFrame, views: DataFrame) -> DataFrame:
    """Sales, product page views and conversion of every catalogued item.

    `items` is silver.items; `purchases` and `views` are silver facts in either
    form. Both facts are stacked into one stream of (item, measures) and summed
    once: one shuffle of partial sums and one join, instead of one each per
    fact. A measure no row contributed to stays NULL, which is what keeps the
    conversion of a never-sold item NULL.
    """
    sales = purchases.select(
        "item_id",
        F.col("quantity").cast("long").alias("sold"),
        F.when(F.col("id").isNotNull(), 1).otherwise(0).cast("long").alias("ordered"),
        F.col("total_price").alias("earned"),
        F.lit(None).cast("long").alias("viewed"),
    )
    traffic = views.where(F.col("page") == shop.PRODUCT_PAGE).select(
        "item_id",
        F.lit(None).cast("long").alias("sold"),
        F.lit(None).cast("long").alias("ordered"),
        F.lit(None).cast(purchases.schema["total_price"].dataType).alias("earned"),
        F.lit(1).cast("long").alias("viewed"),
    )
    measures = ("sold", "ordered", "earned", "viewed")
    per_item = (
        sales.unionByName(traffic)
        .where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(*(F.sum(name).alias(name) for name in measures))
    )
    return performance_of(items, per_item)


def performance_of(items: DataFrame, per_item: DataFrame) -> DataFrame:
    """silver.items with what was summed per item: sold, ordered, earned and viewed, each
    NULL where no row contributed."""
    catalogue = items.select(
        F.col("id").alias("item_id"),
        F.col("name").alias("item_name"),
        F.col("category").alias("item_category"),
    )
    found = catalogue.join(per_item, "item_id", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "item_id",
        "item_name",
        "item_category",
        F.coalesce("sold", zero).alias("items_sold"),
        F.coalesce("ordered", zero).alias("orders"),
        F.coalesce("earned", zero).try_cast(REVENUE).alias("revenue"),
        F.coalesce("viewed", zero).alias("pageviews"),
        shop.conversion(F.col("ordered"), F.col("viewed")).alias("conversion_rate"),
    )


def item_revenue(purchases: DataFrame, bronze_items: DataFrame) -> DataFrame:
    """Revenue per item and label, straight from narrow purchases.

    Sums per item first and labels the sums; grouping the labelled sums again
    keeps the result exact should an item number carry several labels.
    """
    per_item = purchases.groupBy("item_id").agg(F.sum("total_price").alias("total_price"))
    return labelled_revenue(per_item, bronze_items)


def labelled_revenue(per_item: DataFrame, bronze_items: DataFrame) -> DataFrame:
    """Revenue per item (item_id, total_price) by item and label."""
    labels = {"name": "item_name", "category": "item_category"}
    return _revenue_by_label(lookup(per_item, bronze_items, "item_id", "id", labels))


def _revenue_by_label(purchases: DataFrame) -> DataFrame:
    total = F.sum("total_price").try_cast(REVENUE)
    return purchases.groupBy("item_id", "item_name", "item_category").agg(
        total.alias("total_revenue")
    )


def top_selling_items(
    purchases: DataFrame, bronze_items: DataFrame | None = None, k: int = TOP_SELLERS
) -> DataFrame:
    """The k items with the highest revenue, unknown items included.

    Takes silver.purchases_enriched, or narrow purchases plus the items to label
    them from. Equal revenue is ordered by item number.
    """
    if bronze_items is None:
        revenue = _revenue_by_label(purchases)
    else:
        revenue = item_revenue(purchases, bronze_items)
    return top_revenue(revenue, k)


def top_revenue(revenue: DataFrame, k: int = TOP_SELLERS) -> DataFrame:
    return top_k(revenue, k, F.desc_nulls_last("total_revenue"), F.asc("item_id"),
                 F.asc("item_name"), F.asc("item_category"))


def recent(purchases: DataFrame, hours: int, as_of: datetime | None = None) -> DataFrame:
    """Purchases of the last hours. The day test follows from the time test; it is
    there so that a store laid out by day opens only the days in question."""
    start = clock.hours_before(hours, as_of)
    moment = F.col("created_at")
    day = F.col("purchase_date")
    return purchases.where(
        (day >= F.to_date(start)) & (moment >= start)
        & clock.not_after(moment, as_of)
        & clock.not_after(day, as_of, by_day=True)
    )


def sales_performance_24h(purchases: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Revenue by hour of day; a window across midnight folds two dates into one hour."""
    total = F.sum("total_price").try_cast(REVENUE)
    return (
        recent(purchases, 24, as_of)
        .groupBy("purchase_hour")
        .agg(total.alias("total_revenue"))
        .orderBy("purchase_hour")
    )


def hourly_revenue(
    purchases: DataFrame, hours: int = 24, as_of: datetime | None = None
) -> DataFrame:
    """Revenue by clock hour with its date, the variant without folding."""
    total = F.sum("total_price").try_cast(REVENUE)
    return (
        recent(purchases, hours, as_of)
        .groupBy(F.date_trunc("hour", "created_at").alias("purchase_hour_start"))
        .agg(total.alias("total_revenue"))
        .orderBy("purchase_hour_start")
    )


def pageviews_by_channel(views: DataFrame) -> DataFrame:
    return (
        views.groupBy("channel")
        .agg(F.count(F.lit(1)).alias("total_pageviews"))
        .orderBy(F.desc("total_pageviews"), F.asc("channel"))
    )


def visits(views: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Views, active days and last active day per user.

    The exact distinct count is reduced to one row per user and day on the map
    side before its first shuffle.
    """
    day = F.to_date("received_at")
    return (
        views.where(F.col("user_id").isNotNull())
        .where(clock.not_after(F.col("received_at"), as_of))
        .groupBy("user_id")
        .agg(
            F.count("page").alias("page_count"),
            F.count_distinct(day).alias("day_count"),
            F.max(day).alias("last_day"),
        )
    )


def user_engagement_segments(
    users: DataFrame,
    views: DataFrame,
    as_of: datetime | None = None,
    rules: Sequence[shop.SegmentRule] = shop.SEGMENT_RULES,
) -> DataFrame:
    """Every user with a valid e-mail, by recency and frequency of item page views."""
    return segments_of(users, visits(views, as_of), as_of, rules)


def segments_of(
    users: DataFrame,
    visited: DataFrame,
    as_of: datetime | None = None,
    rules: Sequence[shop.SegmentRule] = shop.SEGMENT_RULES,
) -> DataFrame:
    """The same from visits per user: page_count, day_count and last_day."""
    reachable = users.where("valid_email").select(
        F.col("id").alias("user_id"), "email", "full_name"
    )
    zero = F.lit(0).cast("long")
    total = F.coalesce("page_count", zero)
    idle = F.date_diff(clock.today(as_of), F.col("last_day"))
    return reachable.join(visited, "user_id", "left").select(
        "user_id",
        "email",
        "full_name",
        total.alias("total_pageviews"),
        F.coalesce("day_count", zero).alias("active_days"),
        F.col("last_day").alias("last_active_date"),
        idle.alias("days_since_last_active"),
        shop.segment_label(total, idle, rules).alias("engagement_segment"),
    )


def rfm_segments(
    users: DataFrame,
    views: DataFrame,
    purchases: DataFrame,
    spender_minimum: int,
    as_of: datetime | None = None,
) -> DataFrame:
    """Engagement segments with the third axis: what each user spent, and whether
    that reaches `spender_minimum`."""
    spent = (
        purchases.where(F.col("user_id").isNotNull())
        .where(clock.not_after(F.col("created_at"), as_of))
        .groupBy("user_id")
        .agg(F.sum("total_price").alias("spent"))
    )
    segments = user_engagement_segments(users, views, as_of)
    total = F.coalesce(F.col("spent"), F.lit(0)).try_cast(REVENUE)
    return segments.join(spent, "user_id", "left").select(
        *segments.columns,
        total.alias("total_spent"),
        F.when(total >= spender_minimum, "high_value").otherwise("low_value").alias("value_segment"),
    )
