from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierstone.contracts import PRICE
from tierstone.functions import shop


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "email, valid",
    [
        ("ann@example.com", True),
        ("a.b+c%d_e-f@sub.example.org", True),
        ("bad-1", False),
        ("a@b", False),
        ("a@b.c", False),
        ("two@@example.com", False),
        ("", False),
        (None, None),
    ],
)
def test_email_validity_has_three_values(spark, email, valid):
    assert value(spark, shop.is_valid_email(F.lit(email).cast("string"))) is valid


@pytest.mark.parametrize(
    "parts, name",
    [(("A", "B"), "A B"), ((None, "B"), "B"), (("A", None), "A"), ((None, None), "")],
)
def test_joined_name_skips_missing_parts(spark, parts, name):
    columns = [F.lit(p).cast("string") for p in parts]
    assert value(spark, shop.joined_name(*columns)) == name


@pytest.mark.parametrize(
    "price, floored", [("-1.50", "0.00"), ("0.00", "0.00"), ("12.34", "12.34"), (None, None)]
)
def test_price_floor_keeps_type_and_null(spark, price, floored):
    column = shop.floor_at_zero(F.lit(price).cast(PRICE), PRICE)
    df = spark.range(1).select(column.alias("v"))
    assert df.schema["v"].dataType == PRICE
    assert df.first()["v"] == (None if floored is None else Decimal(floored))


@pytest.mark.parametrize(
    "url, page, item",
    [
        ("/products/42", "products", 42),
        ("/cart/7", "cart", 7),
        ("/a/b/7", "", 7),
        ("/7", "", 7),
        ("/about", "", None),
        ("/products/", "", None),
        ("/products/12x", "", None),
        ("/products/99999999999999999999", "products", None),
        ("", "", None),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, page, item):
    column = F.lit(url).cast("string")
    assert value(spark, shop.page_of(column)) == page
    assert value(spark, shop.item_of(column)) == item


def test_line_total_type_and_overflow(spark):
    def total(quantity, price):
        return shop.line_total(F.lit(quantity).cast("int"), F.lit(price).cast("decimal(12,2)"))

    df = spark.range(1).select(total(3, "2.50").alias("v"))
    assert df.dtypes == [("v", "decimal(14,2)")]
    assert df.first()["v"] == Decimal("7.50")
    assert value(spark, total(2_000_000_000, "9999999999.99")) is None


@pytest.mark.parametrize(
    "orders, views, rate",
    [(2, 4, 0.5), (0, 4, 0.0), (None, 4, None), (3, None, 0.0), (3, 0, 0.0), (None, None, 0.0)],
)
def test_conversion_is_null_only_for_viewed_never_sold(spark, orders, views, rate):
    column = shop.conversion(F.lit(orders).cast("long"), F.lit(views).cast("long"))
    assert value(spark, column) == rate


@pytest.mark.parametrize(
    "views, idle, label",
    [
        (8, 3, "high_engagement"),
        (8, 4, "medium_engagement"),
        (3, 7, "medium_engagement"),
        (3, 8, "low_engagement"),
        (2, 0, "low_engagement"),
        (100, None, "low_engagement"),
        (0, None, "low_engagement"),
    ],
)
def test_segment_edges(spark, views, idle, label):
    column = shop.segment_label(F.lit(views), F.lit(idle).cast("int"))
    assert value(spark, column) == label


def test_segment_rules_are_a_parameter(spark):
    rules = (shop.SegmentRule("loyal", 2, 30),)
    column = shop.segment_label(F.lit(2), F.lit(30), rules, "other")
    assert value(spark, column) == "loyal"
