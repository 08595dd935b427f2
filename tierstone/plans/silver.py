"""Silver: checked, derived and labelled rows.

Each fact has two forms. The narrow form (`priced`, `item_views`) holds what
follows from the row itself and needs no join; gold tables are computed from it.
The full form adds the looked-up labels and is the table people query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS, PRICE
from tierstone.functions import shop
from tierstone.operators.lookup import hot_keys, lookup
from tierstone.operators.once import with_once


def users(bronze_users: DataFrame) -> DataFrame:
    return bronze_users.withColumns(
        {
            "valid_email": shop.is_valid_email(F.col("email")),
            "full_name": shop.joined_name(F.col("first_name"), F.col("last_name")),
        }
    )


def items(bronze_items: DataFrame) -> DataFrame:
    return bronze_items.withColumns(
        {
            "price": shop.floor_at_zero(F.col("price"), PRICE),
            "category": F.upper("category"),
        }
    )


def priced(bronze_purchases: DataFrame) -> DataFrame:
    """Purchases with line total, day and hour of day."""
    return bronze_purchases.withColumns(
        {
            "total_price": shop.line_total(F.col("quantity"), F.col("purchase_price")),
            "purchase_date": F.to_date("created_at"),
            "purchase_hour": F.hour("created_at"),
        }
    )


def purchases_enriched(
    bronze_purchases: DataFrame,
    bronze_users: DataFrame,
    bronze_items: DataFrame,
    salts: int = 1,
) -> DataFrame:
    """Every purchase, labelled. Labels come from bronze, so categories keep their
    source spelling here; purchases of unknown users or items stay, unlabelled.

    What follows from the row itself is added after the lookups, so that their shuffles
    do not carry it. With `salts` > 1, hot users and hot items are found in one pass over
    the bronze purchases, before either lookup."""
    hot = hot_keys(bronze_purchases, ["user_id", "item_id"]) if salts > 1 else {}
    with_buyer = lookup(
        bronze_purchases, bronze_users, "user_id", "id", {"email": "user_email"},
        salts, hot.get("user_id"),
    )
    labelled = _item_labels(with_buyer, bronze_items, salts, hot.get("item_id"))
    return priced(labelled).select(*CONTRACTS["silver.purchases_enriched"].columns)


def item_views(bronze_pageviews: DataFrame, *more: str) -> DataFrame:
    """Page views whose URL ends in an item number, with any further columns."""
    numbered = with_once(bronze_pageviews, "item_id", shop.item_of(F.col("url")))
    return numbered.where(F.col("item_id").isNotNull()).select(
        "user_id", "item_id", shop.page_of(F.col("url")).alias("page"), "channel", "received_at", *more
    )


def pageviews_by_items(
    bronze_pageviews: DataFrame, bronze_items: DataFrame, salts: int = 1
) -> DataFrame:
    """Item page views, labelled from bronze items; views of unknown items stay."""
    views = item_views(bronze_pageviews)
    hot = hot_keys(views, ["item_id"]) if salts > 1 else {}
    labelled = _item_labels(views, bronze_items, salts, hot.get("item_id"))
    return labelled.select(*CONTRACTS["silver.pageviews_by_items"].columns)


def _item_labels(facts: DataFrame, bronze_items: DataFrame, salts: int, hot=None) -> DataFrame:
    labels = {"name": "item_name", "category": "item_category"}
    return lookup(facts, bronze_items, "item_id", "id", labels, salts, hot)
