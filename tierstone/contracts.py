"""Declared shape of every table: columns, types, partitioning and comment.

The names and types below are fixed values: users of the tables rely on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

LONG, INT, TEXT, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
REAL, DAY, TIME = T.DoubleType(), T.DateType(), T.TimestampType()
PRICE = T.DecimalType(7, 2)
UNIT_PRICE = T.DecimalType(12, 2)
LINE_TOTAL = T.DecimalType(14, 2)
REVENUE = T.DecimalType(20, 2)

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Partitioning:
    """How rows are laid out in folders.

    The folder value lives in a column of its own, so that the declared columns
    stay whole in the data files: a day cannot be a folder name without being
    derived first, and an empty string used as one would come back as NULL.
    """

    source: str
    transform: str  # "day" or "value"

    @property
    def column(self) -> str:
        return f"part_{self.source}"

    @property
    def sql_type(self) -> str:
        return "DATE" if self.transform == "day" else "STRING"

    def expression(self) -> Column:
        source = F.col(self.source)
        return F.to_date(source) if self.transform == "day" else source


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[tuple[str, T.DataType], ...]
    comment: str
    partitioning: Partitioning | None = None

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    @property
    def table(self) -> str:
        return self.name.split(".")[1]

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.fields])


def by_day(column: str) -> Partitioning:
    return Partitioning(column, "day")


def by_value(column: str) -> Partitioning:
    return Partitioning(column, "value")


_STAMPS = (("created_at", TIME), ("updated_at", TIME))
_USER = (("id", LONG), ("first_name", TEXT), ("last_name", TEXT), ("email", TEXT), *_STAMPS)
_ITEM = (("id", LONG), ("name", TEXT), ("category", TEXT), ("price", PRICE),
         ("inventory", INT), *_STAMPS)
_LABELS = (("item_name", TEXT), ("item_category", TEXT))

_ALL = (
    Contract("bronze.users", _USER, "Users as delivered by the shop database",
             by_day("created_at")),
    Contract("bronze.items", _ITEM, "Items as delivered by the shop database",
             by_value("category")),
    Contract(
        "bronze.purchases",
        (("id", LONG), ("user_id", LONG), ("item_id", LONG), ("quantity", INT),
         ("purchase_price", UNIT_PRICE), *_STAMPS),
        "Purchases as delivered by the shop database",
        by_day("created_at"),
    ),
    Contract(
        "bronze.pageviews",
        (("user_id", LONG), ("url", TEXT), ("channel", TEXT), ("received_at", TIME)),
        "Page views as delivered by the click log",
        by_day("received_at"),
    ),
    Contract(
        "silver.users",
        (*_USER, ("valid_email", FLAG), ("full_name", TEXT)),
        "Users with e-mail check and full name",
        by_day("created_at"),
    ),
    Contract("silver.items", _ITEM, "Items with usable prices and upper-case categories",
             by_value("category")),
    Contract(
        "silver.purchases_enriched",
        (("id", LONG), ("user_id", LONG), ("item_id", LONG), ("quantity", INT),
         ("purchase_price", UNIT_PRICE), ("total_price", LINE_TOTAL), ("user_email", TEXT),
         *_LABELS, ("purchase_date", DAY), ("purchase_hour", INT), *_STAMPS),
        "Purchases with totals, buyer e-mail and item labels",
        by_day("created_at"),
    ),
    Contract(
        "silver.pageviews_by_items",
        (("user_id", LONG), ("item_id", LONG), ("page", TEXT), *_LABELS,
         ("channel", TEXT), ("received_at", TIME)),
        "Page views that name an item, with item labels",
        by_day("received_at"),
    ),
    Contract(
        "gold.item_performance",
        (("item_id", LONG), *_LABELS, ("items_sold", LONG), ("orders", LONG),
         ("revenue", REVENUE), ("pageviews", LONG), ("conversion_rate", REAL)),
        "Sales, traffic and conversion of every item",
        by_value("item_category"),
    ),
    Contract(
        "gold.top_selling_items",
        (("item_id", LONG), *_LABELS, ("total_revenue", REVENUE)),
        "Items with the highest revenue",
    ),
    Contract(
        "gold.sales_performance_24h",
        (("purchase_hour", INT), ("total_revenue", REVENUE)),
        "Revenue by hour of day over the last 24 hours",
    ),
    Contract(
        "gold.pageviews_by_channel",
        (("channel", TEXT), ("total_pageviews", LONG)),
        "Item page views by channel",
    ),
    Contract(
        "gold.user_engagement_segments",
        (("user_id", LONG), ("email", TEXT), ("full_name", TEXT), ("total_pageviews", LONG),
         ("active_days", LONG), ("last_active_date", DAY), ("days_since_last_active", INT),
         ("engagement_segment", TEXT)),
        "Reachable users by recency and frequency of their visits",
        by_value("engagement_segment"),
    ),
)

CONTRACTS: dict[str, Contract] = {contract.name: contract for contract in _ALL}
