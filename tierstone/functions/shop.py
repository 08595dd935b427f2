"""Column expressions shared by the layer plans."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

from tierstone.contracts import LINE_TOTAL

# Patterns that decide what counts as a valid e-mail, as a page
# name and as an item number in a URL.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PAGE_PATTERN = r"^/([^/]+)/\d+$"
ITEM_PATTERN = r"/(\d+)$"
PRODUCT_PAGE = "products"


class SegmentRule(NamedTuple):
    """A user with at least `views` views and at most `idle_days` idle days gets `label`."""

    label: str
    views: int
    idle_days: int


# Engagement thresholds, the first match wins.
SEGMENT_RULES = (
    SegmentRule("high_engagement", 8, 3),
    SegmentRule("medium_engagement", 3, 7),
)
LOWEST_SEGMENT = "low_engagement"


def is_valid_email(email: Column) -> Column:
    """Three-valued: NULL for a NULL address, so that "unknown" is not "wrong"."""
    return email.rlike(EMAIL_PATTERN)


def joined_name(*parts: Column) -> Column:
    """Name parts with a space between them; missing parts leave no gap."""
    return F.concat_ws(" ", *parts)


def floor_at_zero(amount: Column, kind: T.DataType) -> Column:
    """Negative amounts become zero, NULL stays NULL, the declared type is kept."""
    return F.when(amount < 0, F.lit(0).cast(kind)).otherwise(amount).cast(kind)


def page_of(url: Column) -> Column:
    """First path segment of `/page/number`; the empty string for any other shape."""
    return F.regexp_extract(url, PAGE_PATTERN, 1)


def item_of(url: Column) -> Column:
    """Trailing number of a URL; NULL where there is none or it exceeds a BIGINT.

    No match yields '', turned to NULL before the cast: a failing cast costs an
    exception per row inside the JVM.
    """
    return F.nullif(F.regexp_extract(url, ITEM_PATTERN, 1), F.lit("")).try_cast("bigint")


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times unit price; a total beyond the declared type becomes NULL."""
    return (quantity * unit_price).try_cast(LINE_TOTAL)


def conversion(orders: Column, views: Column) -> Column:
    """Orders per view. 0.0 without views; NULL for viewed items that never sold,
    because `orders` is then missing rather than zero."""
    return F.when(views > 0, orders / views).otherwise(F.lit(0.0)).cast("double")


def segment_label(
    views: Column,
    idle_days: Column,
    rules: Sequence[SegmentRule] = SEGMENT_RULES,
    otherwise: str = LOWEST_SEGMENT,
) -> Column:
    """Label of the first rule met; unknown recency meets none."""
    matches = [
        F.when((views >= rule.views) & (idle_days <= rule.idle_days), F.lit(rule.label))
        for rule in rules
    ]
    return F.coalesce(*matches, F.lit(otherwise))
